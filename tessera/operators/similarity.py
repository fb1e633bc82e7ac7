"""Edit-distance search: one query at a time (sweep) or many at once (join).

Two exact candidate generators feed the join, chosen by target length so that
every pair is generated by exactly one of them:

* short targets (length <= L0): deletion neighbourhoods, below;
* long targets: partition signatures (pigeonhole, after PassJoin, Li et al.,
  VLDB 2011). DL(a, b) <= k implies Levenshtein <= 2k and a length difference
  <= k; cut the target into 2k + 1 segments and at most 2k of them are touched
  by the edits, so one segment appears verbatim in the query, shifted by at
  most 2k positions. A target emits its 2k + 1 segments; a query emits, for
  every compatible length and segment, the substrings at the 4k + 1 possible
  shifts: a bounded number of signatures however long the strings are.

L0 is where a deletion neighbourhood becomes larger than a query's signature
set, so neither side ever expands by more than that bound.

Deletion neighbourhoods: if ``DL(a, b) <= k`` then deleting at most ``k``
characters from each side reaches a common string (a substitution is a deletion
on both sides; an adjacent transposition is one deletion on each side).

Either way every matching pair meets on a shared hashed key, and the search is
an ordinary hash-partitioned equi-join: no cross join, no broadcast of a side
that grows with the data. Strings are de-duplicated before expansion, so a hot
value is expanded once. A shared key is necessary, not sufficient: where the key
is a segment, the join emits a pair only if what lies left and right of it is
within Levenshtein distance 2k altogether, so strings that merely share a segment
make no rows. Candidates go through the JVM prefilters and then the exact kernel.

Strings with much in common (one prefix, say) would still all be *compared* within the
key of that part. So a long target has a second, finer cut: of its m segments at least
m - 2k are untouched, so any 2k + 1 of them will do, and it keeps the rarest among all
targets. It uses whichever cut has the rarer segments altogether; queries emit the
signatures of both.

``fuzzy_sweep`` is a scan + filter: the same prefilters, then the kernel on the
survivors only.
"""

from __future__ import annotations

from math import comb

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.edit_distance import damerau_levenshtein_within, within_prefilter


def _one_deletion_sql(var: str, idx: str) -> str:
    # every string obtained from `var` by deleting exactly one character
    n = f"char_length({var})"
    return (
        f"transform(filter(sequence(1, greatest({n}, 1)), {idx} -> {idx} <= {n}), "
        f"{idx} -> concat(substr({var}, 1, {idx} - 1), substr({var}, {idx} + 1)))"
    )


def deletion_variants(col: str, k: int) -> Column:
    """All distinct strings reachable from ``col`` by deleting at most ``k`` characters.

    For a string of length L there are at most sum_{m<=k} C(L, m) variants.
    Built from Spark higher-order functions (JVM-side, no Python).
    """
    if k < 0:
        raise ValueError("k must be >= 0")
    # level m: every string of level m - 1 plus its one-deletion variants; each
    # level refers to the previous one once, so nothing is evaluated twice
    level = f"array(`{col}`)"
    for m in range(1, k + 1):
        v, i = f"v{m}", f"i{m}"
        level = f"array_distinct(flatten(transform({level}, {v} -> concat(array({v}), {_one_deletion_sql(v, i)}))))"
    return F.expr(level)


def deletion_count(length: int, k: int) -> int:
    """Variants of a string of ``length`` distinct characters within ``k`` deletions."""
    return sum(comb(length, m) for m in range(k + 1))


def partition_signature_count(k: int) -> int:
    """Signatures a query emits in the partition scheme (lengths x segments x shifts)."""
    tau = 2 * k
    return (2 * k + 1) * (tau + 1) * (2 * tau + 1)


def switch_length(k: int) -> int:
    """Longest target handled by deletion neighbourhoods (at least 2k, so long targets
    always have non-empty segments). For k = 0 (equality) every target uses them."""
    if k < 0:
        raise ValueError("k must be >= 0")
    if k == 0:
        return 1 << 30
    limit = partition_signature_count(k)
    length = 2 * k
    while deletion_count(length + 1, k) <= limit:
        length += 1
    return length


#: Letters of a segment in the finer cut, and how many times more segments than needed it may have.
FINE_LETTERS, FINE_TIMES = 3, 4
#: Segments that fewer targets share all count as equally rare.
COMMON = 8


def _n_segments_sql(n: str, k: int, fine: bool) -> str:
    """SQL for the number of segments of a string of length ``n`` in the coarse or the fine cut."""
    need = 2 * k + 1
    return f"least(greatest(div({n}, {FINE_LETTERS}), {need}), {FINE_TIMES * need})" if fine else str(need)


def _segment_sql(n: str, i: str, parts: str) -> tuple[str, str]:
    # start (0-based) and length of segment i when a string of length n is cut
    # into so many parts, the shorter parts first
    base = f"div({n}, {parts})"
    n_short = f"({parts} - pmod({n}, {parts}))"
    start = f"({i} * {base} + greatest(0, {i} - {n_short}))"
    length = f"({base} + CASE WHEN {i} >= {n_short} THEN 1 ELSE 0 END)"
    return start, length


KEYS = "array<struct<key:bigint,at:int,len:int>>"


def _tagged(strings: Column, tag: int) -> Column:
    """Keys without a place in the string."""
    return F.transform(strings, lambda v: F.struct(
        F.xxhash64(F.lit(tag), v).alias("key"), F.lit(-1).alias("at"), F.lit(0).alias("len"))).cast(KEYS)


def target_segments(col: str, k: int, fine: bool = False) -> Column:
    """Signature keys of a (long) target: one per segment, keyed by cut, length and segment index."""
    n = f"char_length(`{col}`)"
    parts = _n_segments_sql(n, k, fine)
    start, length = _segment_sql(n, "i", parts)
    return F.expr(
        f"transform(sequence(0, {parts} - 1), i -> named_struct("
        f"'key', xxhash64({2 if fine else 1}, {n}, i, substr(`{col}`, {start} + 1, {length})), "
        f"'at', {start}, 'len', {length}))"
    ).cast(KEYS)


def query_signatures(col: str, k: int, min_target_len: int, fine: bool = False) -> Column:
    """Signature keys of a query against targets longer than ``min_target_len - 1``."""
    tau = 2 * k
    q = f"`{col}`"
    nq = f"char_length({q})"
    parts = _n_segments_sql("m", k, fine)
    start, length = _segment_sql("m", "i", parts)
    inner = (
        f"transform(sequence(-{tau}, {tau}), d -> named_struct("
        f"'ok', {start} + d >= 0 AND {start} + d + {length} <= {nq}, "
        f"'key', xxhash64({2 if fine else 1}, m, i, substr({q}, {start} + d + 1, {length})), 'at', {start} + d, 'len', {length}))"
    )
    per_len = f"flatten(transform(sequence(0, {parts} - 1), i -> {inner}))"
    lengths = f"filter(transform(sequence(-{k}, {k}), e -> {nq} + e), m -> m >= {min_target_len})"
    all_sigs = f"flatten(transform({lengths}, m -> {per_len}))"
    return F.expr(
        f"array_distinct(transform(filter({all_sigs}, x -> x.ok), x -> named_struct('key', x.key, 'at', x.at, 'len', x.len)))"
    ).cast(KEYS)


def distinct_strings(df: DataFrame, col: str, name: str) -> DataFrame:
    return df.select(F.col(col).alias(name)).where(F.col(col).isNotNull()).distinct()


def query_keys(qs: DataFrame, k: int) -> DataFrame:
    """``_q, _key, _q_at, _q_len``: every key under which a string may meet a target."""
    l0, length = switch_length(k), F.char_length("_q")
    empty = F.array().cast(KEYS)
    signatures = F.concat(query_signatures("_q", k, l0 + 1), query_signatures("_q", k, l0 + 1, fine=True))
    keys = F.concat(
        F.when(length <= l0 + k, _tagged(deletion_variants("_q", k), 0)).otherwise(empty),
        F.when(length >= l0 + 1 - k, signatures).otherwise(empty),
    )
    return qs.select("_q", F.inline(keys)).toDF("_q", "_key", "_q_at", "_q_len")


def target_keys(ts: DataFrame, k: int, known: DataFrame | None = None) -> DataFrame:
    """``_t, _key, _t_at, _t_len``: the keys under which a target is met.

    Short targets by shared deletion variant; long ones by the segments of the cut whose segments fewer
    targets share (those of ``known``, with a ``_key`` each, count too). Segments are counted before
    the shuffle; common ones alone are joined back.
    """
    l0, length = switch_length(k), F.char_length("_t")
    columns = ["_t", "_key", "_t_at", "_t_len"]
    short = ts.where(length <= l0).select("_t", F.inline(_tagged(deletion_variants("_t", k), 0))).toDF(*columns)
    if k == 0:
        return short  # every target is met under itself
    long = ts.where(length > l0)

    def of_cut(cut: int) -> Column:
        return F.transform(target_segments("_t", k, fine=bool(cut)), lambda x: F.struct(F.lit(cut).alias("cut"), x["key"], x["at"], x["len"]))

    segments = long.select("_t", F.inline(F.concat(of_cut(0), of_cut(1)))).toDF("_t", "_cut", "_key", "_t_at", "_t_len")
    counted = segments.select("_key")
    if known is not None:
        counted = counted.union(known.select("_key").join(counted.distinct(), "_key", "left_semi"))
    common = counted.groupBy("_key").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= COMMON)
    per_target = segments.join(common, "_key", "left").groupBy("_t").agg(F.sort_array(F.collect_list(F.struct(
        "_cut", F.coalesce("_n", F.lit(COMMON)).alias("n"), F.col("_key").alias("key"), F.col("_t_at").alias("at"),
        F.col("_t_len").alias("len")))).alias("found"))
    coarse = F.filter("found", lambda x: x["_cut"] == 0)
    rarest = F.slice(F.filter("found", lambda x: x["_cut"] == 1), 1, 2 * k + 1)

    def shared(segments: Column) -> Column:
        return F.aggregate(segments, F.lit(0).cast("bigint"), lambda total, x: total + x["n"])

    chosen = F.when(shared(coarse) <= shared(rarest), coarse).otherwise(rarest)
    keys = F.transform(chosen, lambda x: F.struct(x["key"].alias("key"), x["at"].alias("at"), x["len"].alias("len"))).cast(KEYS)
    return short.union(per_target.select("_t", F.inline(keys)).toDF(*columns))


def fuzzy_sweep(df: DataFrame, col: str, query: str, k: int, distance_col: str = "distance") -> DataFrame:
    """Rows whose ``col`` is within Damerau-Levenshtein distance ``k`` of ``query``.

    Distinct strings are compared once and joined back to their rows.
    """
    q = F.lit(query)
    survivors = df.select(F.col(col).alias("_s")).where(within_prefilter(F.col("_s"), q, k)).distinct()
    near = survivors.withColumn(distance_col, damerau_levenshtein_within(F.col("_s"), q, k)).where(F.col(distance_col) <= k)
    return df.join(near, df[col] == near["_s"]).drop("_s")


def _sides_within(tau: int) -> Column:
    """What is left and what is right of the shared segment, together within ``tau`` edits."""
    def side(text: str, prefix: str, left: bool) -> Column:
        at, size = F.col(f"{prefix}_at"), F.col(f"{prefix}_len")
        return F.substring(text, F.lit(1), at) if left else F.substring(text, at + size + 1, F.char_length(text))

    left = F.levenshtein(side("_q", "_q", True), side("_t", "_t", True), tau)
    right = F.levenshtein(side("_q", "_q", False), side("_t", "_t", False), tau)
    return (F.col("_t_at") < 0) | ((left >= 0) & (right >= 0) & (left + right <= tau))


def pairs_by_key(qk: DataFrame, tk: DataFrame, k: int) -> DataFrame:
    """``query_sequence, sequence, distance`` of the pairs that share a key and are within ``k``."""
    cand = qk.join(tk, "_key").where(_sides_within(2 * k)).select("_q", "_t").distinct()
    cand = cand.where(within_prefilter(F.col("_q"), F.col("_t"), k))
    scored = cand.withColumn("_d", damerau_levenshtein_within(F.col("_q"), F.col("_t"), k)).where(F.col("_d") <= k)
    return scored.select(
        F.col("_q").alias("query_sequence"), F.col("_t").alias("sequence"), F.col("_d").alias("distance")
    )


def fuzzy_pairs(queries: DataFrame, q_col: str, targets: DataFrame, t_col: str, k: int) -> DataFrame:
    """Distinct ``(query, target, distance)`` with ``DL(query, target) <= k``."""
    qk = query_keys(distinct_strings(queries, q_col, "_q"), k)
    return pairs_by_key(qk, target_keys(distinct_strings(targets, t_col, "_t"), k), k)


def fuzzy_join(
    queries: DataFrame,
    q_col: str,
    targets: DataFrame,
    t_col: str,
    k: int,
) -> DataFrame:
    """Every target row whose ``t_col`` lies within distance ``k`` of some query string.

    Output: the target's columns plus ``query_sequence`` and ``distance``.
    """
    pairs = fuzzy_pairs(queries, q_col, targets, t_col, k)
    return targets.join(pairs.withColumnRenamed("sequence", "_match"), F.col(t_col) == F.col("_match")).drop("_match")
