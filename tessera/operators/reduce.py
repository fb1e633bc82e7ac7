"""Reduce an export to one row per grain (sequence, epitope id, restriction).

Plan shape (one scan, one shuffle for the whole reduction):

    scan -> filter -> project -> partial ObjectHashAggregate (grain)
         -> Exchange hashpartitioning(grain) -> final aggregate -> project

Every per-group value (modal scalars, the modal position pair, distinct lists,
counts) is an aggregate over the same grouping, so there is no self-join and no
second pass over the input. Grains known to be heavy can take a second path that
counts values instead of holding them (``heavy=``).
"""

from __future__ import annotations

from functools import reduce as _fold

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import accession, clean_sequence, epitope_id, flag_matches
from tessera.operators.aggregates import (
    distinct_sorted_list,
    first_non_null,
    member_bits,
    modal_tuple,
    modal_value,
    row_count,
    tuple_member,
)

# The grain of the reduced table, the object type that carries a
# matchable sequence, and the export columns (slugs) the reduction reads.
GRAIN = ("sequence", "iedb_epitope_id", "mhc_allele")
MATCHABLE_OBJECT_TYPE = "Linear peptide"
SOURCE_COLUMNS = {
    "object_type": "epitope_object_type",
    "name": "epitope_name",
    "epitope_iri": "epitope_epitope_iri",
    "restriction_name": "mhc_restriction_name",
    "restriction_class": "mhc_restriction_class",
    "parent_iri": "epitope_molecule_parent_iri",
    "source_iri": "epitope_source_molecule_iri",
    "source_molecule": "epitope_source_molecule",
    "start": "epitope_starting_position",
    "end": "epitope_ending_position",
    "pmid": "reference_pmid",
    "modified_residues": "epitope_modified_residues",
    "modifications": "epitope_modifications",
}

REDUCED_COLUMNS = (
    "sequence",
    "peptide_length",
    "iedb_epitope_id",
    "mhc_allele",
    "mhc_class",
    "allele_is_specific",
    "uniprot_id",
    "source_molecule",
    "start_position",
    "end_position",
    "pmids",
    "n_pmids",
    "is_modified",
    "modifications",
    "modified_residues",
    "n_assays",
)


def extract_fields(
    export: DataFrame,
    columns: dict[str, str] | None = None,
    object_type: str | None = MATCHABLE_OBJECT_TYPE,
) -> DataFrame:
    """Keep matchable rows and project the eleven fields the reduction needs.

    The filter is placed before the projection so it reaches the scan
    (Parquet row-group pruning / CSV pushed filters).
    """
    c = {**SOURCE_COLUMNS, **(columns or {})}
    df = export
    if object_type is not None:
        df = df.where(F.col(c["object_type"]) == F.lit(object_type))
    return df.select(
        clean_sequence(c["name"]).alias("sequence"),
        epitope_id(c["epitope_iri"]).alias("iedb_epitope_id"),
        F.col(c["restriction_name"]).alias("mhc_allele"),
        F.col(c["restriction_class"]).alias("mhc_class"),
        accession([c["parent_iri"], c["source_iri"]]).alias("uniprot_id"),
        F.col(c["source_molecule"]).alias("source_molecule"),
        F.col(c["start"]).alias("start_position"),
        F.col(c["end"]).alias("end_position"),
        F.col(c["pmid"]).alias("pmid"),
        F.col(c["modified_residues"]).alias("modified_residues"),
        F.col(c["modifications"]).alias("modifications"),
    )


def _narrow(value: Column, target: str, what: str) -> Column:
    """Cast to a narrower integer type; a value that does not fit raises (ANSI or not)."""
    overflow = F.when(value.isNotNull(), F.raise_error(F.concat(F.lit(f"{what} does not fit {target}: "),
                                                                 value.cast("string"))))
    return F.coalesce(value.try_cast(target), overflow.cast(target))


def keys_present(keys) -> Column:
    """True when no key column is null (an equi-join would match the row)."""
    return _fold(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


def _column(name: str, value: Column, description: str, source: str) -> Column:
    return value.alias(name, metadata={"description": description, "source": source})


#: Above so many rows a grain may hold more distinct values than a task should keep in maps.
HEAVY_ROWS = 1_000_000


def heavy_grains(fields: DataFrame, grain=GRAIN, rows: int = HEAVY_ROWS) -> DataFrame:
    """Grains of more than ``rows`` rows: never more of them than the input has rows, divided by ``rows``."""
    grain = list(grain)
    return fields.groupBy(*grain).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > rows).select(*grain)


def _fused(fields: DataFrame, grain: list[str]) -> DataFrame:
    """Every aggregate in one pass and one shuffle; buffers hold the distinct values of a grain."""
    return fields.groupBy(*grain).agg(
        first_non_null("mhc_class").alias("mhc_class"),
        modal_value("uniprot_id").alias("uniprot_id"),
        modal_value("source_molecule").alias("source_molecule"),
        modal_tuple("start_position", "end_position",
                    bits=member_bits(dict(fields.dtypes), ("start_position", "end_position"))).alias("_pair"),
        distinct_sorted_list("pmid").alias("pmids"),
        distinct_sorted_list("modifications").alias("modifications"),
        distinct_sorted_list("modified_residues").alias("modified_residues"),
        row_count().alias("n_assays"),
    )


def _counted(fields: DataFrame, grain: list[str]) -> DataFrame:
    """The same values from counts of (grain, column, value), for grains of any number of distinct values.

    A row is dealt by grain *and value*, after counting inside each task, so no task gets a whole grain; what is
    left for the grain is a least struct per column, which takes constant room. (The lists are part of
    the result and need theirs.)
    """
    texts = ("mhc_class", "uniprot_id", "source_molecule", "modifications", "modified_residues")
    pair = ("start_position", "end_position")

    def value(column: str, text: Column | None = None, first: Column | None = None, second: Column | None = None) -> Column:
        return F.struct(F.lit(column).alias("_column"), (F.lit(None) if text is None else text).cast("string").alias("_text"),
                        (F.lit(None) if first is None else first).cast("bigint").alias("_first"),
                        (F.lit(None) if second is None else second).cast("bigint").alias("_second"))

    values = F.array(*[value(c, text=F.col(c)) for c in texts], value("pmid", first=F.col("pmid")),
                     value("_pair", first=F.col(pair[0]), second=F.col(pair[1])))
    counts = fields.select(*grain, F.inline(values)).groupBy(*grain, "_column", "_text", "_first", "_second").agg(
        F.count(F.lit(1)).alias("_n"))

    def of(column: str, what: Column) -> Column:
        return F.when(F.col("_column") == column, what)

    def mode(column: str) -> Column:
        # the least of (-count, value): most rows first, then the lowest value
        present = F.when(F.col("_text").isNotNull(), F.struct((-F.col("_n")).alias("n"), F.col("_text").alias("v")))
        return F.min(of(column, present))["v"]

    def distinct(column: str, what: str, kind: str) -> Column:
        return F.array_sort(F.collect_list(of(column, F.col(what)))).cast(f"array<{kind}>")

    modal_pair = F.min(of("_pair", F.struct(
        (-F.col("_n")).alias("n"), F.col("_first").isNull().alias("no_first"), F.col("_first").alias(pair[0]),
        F.col("_second").isNull().alias("no_second"), F.col("_second").alias(pair[1]))))
    types = dict(fields.dtypes)
    return counts.groupBy(*grain).agg(
        F.min(of("mhc_class", F.col("_text"))).alias("mhc_class"),
        mode("uniprot_id").alias("uniprot_id"),
        mode("source_molecule").alias("source_molecule"),
        modal_pair.alias("_pair"),
        distinct("pmid", "_first", types["pmid"]).alias("pmids"),
        distinct("modifications", "_text", "string").alias("modifications"),
        distinct("modified_residues", "_text", "string").alias("modified_residues"),
        F.coalesce(F.sum(of("_pair", F.col("_n"))), F.lit(0)).alias("n_assays"),
    ).withColumn("_pair", F.struct(F.col("_pair")[pair[0]].alias(pair[0]), F.col("_pair")[pair[1]].alias(pair[1])))


def _is_one_of(df: DataFrame, keys: DataFrame, grain: list[str], how: str) -> DataFrame:
    """Null-safe semi or anti join on the grain."""
    named = keys.toDF(*[f"_k{i}" for i in range(len(grain))])
    return df.join(named, _fold(lambda a, b: a & b, [F.col(g).eqNullSafe(F.col(f"_k{i}")) for i, g in enumerate(grain)]), how)


def reduce_to_grain(fields: DataFrame, grain=GRAIN, heavy: DataFrame | None = None) -> DataFrame:
    """One row per grain with modal, list and count aggregates (16 columns).

    Groups whose grain holds a null key keep null positions: the modal pair is
    defined by an equi-join on the grain, which never matches null keys.

    ``heavy`` names grains (as :func:`heavy_grains` finds them; write them first, they are read twice) that are
    reduced by counting values instead of holding them in maps, with the same result.
    """
    grain = list(grain)
    if heavy is None:
        aggregated = _fused(fields, grain)
    else:
        aggregated = _fused(_is_one_of(fields, heavy, grain, "left_anti"), grain).unionByName(
            _counted(_is_one_of(fields, heavy, grain, "left_semi"), grain))
    keyed = keys_present(grain)
    src = SOURCE_COLUMNS
    return aggregated.select(
        _column("sequence", F.col("sequence"), "residues only, without a modification note", src["name"]),
        _column("peptide_length", _narrow(F.char_length("sequence"), "smallint", "peptide length"),
                "residues in sequence", "sequence"),
        _column("iedb_epitope_id", F.col("iedb_epitope_id"), "number at the end of the IRI", src["epitope_iri"]),
        _column("mhc_allele", F.col("mhc_allele"), "restriction, unchanged", src["restriction_name"]),
        _column("mhc_class", F.col("mhc_class"), "a class that some row of the group names", src["restriction_class"]),
        _column("allele_is_specific", flag_matches("mhc_allele"), "whether the restriction names one allele", "mhc_allele"),
        _column("uniprot_id", F.col("uniprot_id"), "accession that most rows have",
                f"{src['parent_iri']}, {src['source_iri']}"),
        _column("source_molecule", F.col("source_molecule"), "molecule name that most rows have", src["source_molecule"]),
        _column("start_position", F.when(keyed, tuple_member("_pair", "start_position")).cast("int"),
                "first position, of the pair that most rows have", src["start"]),
        _column("end_position", F.when(keyed, tuple_member("_pair", "end_position")).cast("int"),
                "last position, of the pair that most rows have", src["end"]),
        _column("pmids", F.col("pmids"), "publications, each once, ascending", src["pmid"]),
        _column("n_pmids", F.size("pmids").cast("int"), "number of publications", "pmids"),
        _column("is_modified", F.size("modifications") > 0, "whether any row is modified", "modifications"),
        _column("modifications", F.col("modifications"), "modifications, each once, ascending", src["modifications"]),
        _column("modified_residues", F.col("modified_residues"), "modified residues, each once, ascending",
                src["modified_residues"]),
        _column("n_assays", F.col("n_assays"), "export rows of the group", "every row"),
    )


def modal_pair_per_grain(fields: DataFrame, grain=GRAIN, cols=("start_position", "end_position")) -> DataFrame:
    """The modal combination of ``cols`` per grain, as its own table (null keys -> null pair)."""
    grain = list(grain)
    keyed = keys_present(grain)
    out = fields.groupBy(*grain).agg(modal_tuple(*cols, bits=member_bits(dict(fields.dtypes), cols)).alias("_pair"))
    types = dict(fields.dtypes)
    return out.select(*grain, *[F.when(keyed, tuple_member("_pair", c)).cast(types[c]).alias(c) for c in cols])


def sort_by_grain(df: DataFrame, grain=GRAIN) -> DataFrame:
    """Global order by the grain, ascending with nulls first (range-partitioned sort).

    Sorted output gives tight min/max statistics per row group, so an equality
    lookup on ``sequence`` skips most of the file.
    """
    return df.orderBy(*[F.col(k).asc_nulls_first() for k in grain])
