"""Export-shaped frame built from the driver's TPC-H-style tables.

The driver tables hold no ligand export, so every registered query first derives
one with the same 14 slugged columns the reduction and the reports read, from
``lineitem JOIN part``. The arithmetic is fixed (see FIXTURES.md section 4) and is
mirrored one-for-one by :data:`EXPORT_FRAME_SQL` for the DuckDB oracle.

Scale: ``part`` grows with the data too, so the join is left to the optimizer
(AQE broadcasts it only when its measured size is under the threshold, and
otherwise sort-merges on the part key). Where the session has too few shuffle
partitions for the rows, ``part`` asks for more, and a sort-merge join follows
it: a task sorts about :data:`JOIN_ROWS` rows of lineitem, however many there
are. Only three part columns are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


#: Rows of lineitem that one task of the join sorts, about.
JOIN_ROWS = 500_000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(col) -> F.Column:
    return col.cast("string")


def export_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The export-shaped frame E (typed like the imported export)."""
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
    )
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type")
    n_tasks = li.count() // JOIN_ROWS + 1  # from the footers
    if n_tasks > int(spark.conf.get("spark.sql.shuffle.partitions")):
        part = part.repartition(n_tasks, "p_partkey")
    j = li.join(part, li.l_partkey == part.p_partkey, "inner")

    modified = F.col("l_discount") >= 0.08
    class_one = F.col("l_linestatus") == "F"
    qty_pos = F.when(F.col("l_quantity") >= 10, F.col("l_quantity").cast("int") % 5)
    return j.select(
        F.concat(
            F.upper("p_name"),
            F.when(modified, F.concat(F.lit(" + OX("), _s(F.col("l_linenumber")), F.lit(")"))).otherwise(F.lit("")),
        ).alias("epitope_name"),
        F.concat(F.lit("http://ex.org/epitope/"), _s(F.col("l_partkey") % 40)).alias("epitope_epitope_iri"),
        F.when(F.col("l_linenumber") == 7, F.lit(None).cast("string"))
        .when(class_one, F.concat(F.lit("HLA-A*0"), _s(F.col("l_suppkey") % 4), F.lit(":01")))
        .otherwise(F.lit("HLA class I"))
        .alias("mhc_restriction_name"),
        F.when(class_one, F.lit("I")).otherwise(F.lit("II")).alias("mhc_restriction_class"),
        F.when(F.col("l_returnflag") == "R", F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("http://ex.org/uniprot/P"), _s(F.col("l_suppkey") % 9)))
        .alias("epitope_molecule_parent_iri"),
        F.when(F.col("l_linenumber") < 4, F.concat(F.lit("http://ex.org/uniprot/Q"), _s(F.col("l_suppkey") % 5)))
        .otherwise(F.concat(F.lit("http://ex.org/protein/"), _s(F.col("l_suppkey"))))
        .alias("epitope_source_molecule_iri"),
        F.col("p_type").alias("epitope_source_molecule"),
        qty_pos.alias("epitope_starting_position"),
        (qty_pos + 8).alias("epitope_ending_position"),
        (F.col("l_orderkey") % 1000).cast("int").alias("reference_pmid"),
        F.year("l_shipdate").cast("smallint").alias("reference_date"),
        F.when(modified, F.lit("OX")).alias("epitope_modifications"),
        F.when(modified, F.concat(F.lit("M"), _s(F.col("l_linenumber")))).alias("epitope_modified_residues"),
        F.when(F.col("l_tax") > 0.07, F.lit("Other")).otherwise(F.lit("Linear peptide")).alias("epitope_object_type"),
    )


# The same frame in DuckDB SQL (oracle side). Kept textually next to the Spark
# version so the two stay in step.
EXPORT_FRAME_SQL = """
SELECT
  upper(p_name) || CASE WHEN l_discount >= 0.08 THEN ' + OX(' || l_linenumber::varchar || ')' ELSE '' END
    AS epitope_name,
  'http://ex.org/epitope/' || (l_partkey % 40)::varchar AS epitope_epitope_iri,
  CASE WHEN l_linenumber = 7 THEN NULL
       WHEN l_linestatus = 'F' THEN 'HLA-A*0' || (l_suppkey % 4)::varchar || ':01'
       ELSE 'HLA class I' END AS mhc_restriction_name,
  CASE WHEN l_linestatus = 'F' THEN 'I' ELSE 'II' END AS mhc_restriction_class,
  CASE WHEN l_returnflag = 'R' THEN NULL ELSE 'http://ex.org/uniprot/P' || (l_suppkey % 9)::varchar END
    AS epitope_molecule_parent_iri,
  CASE WHEN l_linenumber < 4 THEN 'http://ex.org/uniprot/Q' || (l_suppkey % 5)::varchar
       ELSE 'http://ex.org/protein/' || l_suppkey::varchar END AS epitope_source_molecule_iri,
  p_type AS epitope_source_molecule,
  CASE WHEN l_quantity < 10 THEN NULL ELSE l_quantity::int % 5 END AS epitope_starting_position,
  CASE WHEN l_quantity < 10 THEN NULL ELSE l_quantity::int % 5 + 8 END AS epitope_ending_position,
  (l_orderkey % 1000)::int AS reference_pmid,
  year(l_shipdate)::smallint AS reference_date,
  CASE WHEN l_discount >= 0.08 THEN 'OX' END AS epitope_modifications,
  CASE WHEN l_discount >= 0.08 THEN 'M' || l_linenumber::varchar END AS epitope_modified_residues,
  CASE WHEN l_tax > 0.07 THEN 'Other' ELSE 'Linear peptide' END AS epitope_object_type
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
"""
