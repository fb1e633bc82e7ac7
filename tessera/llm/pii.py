"""Personal data: fixed patterns, and identifiers that bootstrapped contexts give away.

Entities that the fixed patterns find are seeds. The tokens around them and their shapes are
lexical patterns; patterns and the tokens they occur with form a graph in which patterns are
scored by the tokens and tokens by the patterns, a few times over. Tokens that no fixed pattern
accepts but high-confidence patterns point to become spans as well. All of it is DataFrame code.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import text_or_empty, written
from tessera.llm.text_stats import let

KINDS = ("email", "ip", "card", "phone")

# The contract's patterns, written so that each place is tried once: a match starts where the run
# that it begins with starts, or where the match before ended; possessive, since nothing follows
# that a shorter run could help.
_LOCAL = r"[A-Za-z0-9._%+-]"
_PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_PART = r"0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2}|(?<=0))"
#: A token with a digit or an @, seen from its first character; every fixed pattern's match has one of them.
_TOKEN = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9@]*+[0-9@][^\x20\x09-\x0D]*+"

SPAN = "array<struct<kind:int,start:int,end:int>>"
MENTION = "array<struct<start:int,end:int,token:string,left:string,right:string>>"

#: Values folded at a time by :func:`running`; code points of the chunks that text is cut into, large ones first.
FOLD, LARGE_CHUNK, CHUNK = 256, 65_536, 1024
#: Code points of a cell: spans that overlap have a cell in common.
CELL = 64

ROUNDS = 3
#: A pattern counts once it holds this many different seeds, a token once its score reaches CONFIDENT.
MIN_SEEDS = 5
CONFIDENT = 0.8


def _accepted(kind: str, found: Column) -> Column:
    digits = F.regexp_replace(found, "[^0-9]", "")
    if kind == "ip":
        return found.rlike(rf"^{_PART}(?:\.{_PART}){{3}}$")
    if kind == "card":
        def luhn(d: Column) -> Column:
            n = F.char_length(d)

            def weighted(i: Column) -> Column:
                twice = F.substring(d, n - i, F.lit(1)).cast("int") * (1 + i % 2)
                return F.when(twice > 9, twice - 9).otherwise(twice)

            return F.aggregate(F.transform(F.sequence(F.lit(0), n - 1), weighted), F.lit(0), lambda a, b: a + b) % 10 == 0

        return F.char_length(digits).between(16, 19) & let(digits, luhn)
    if kind == "phone":
        return F.char_length(digits).between(8, 15)
    return F.lit(True)


def running(values: Column, kind: str, merge: Callable[[Column, Column], Column], start: Column) -> Column:
    """What ``merge`` makes of all values before each one, from ``start`` on.

    A fold that grows an array copies it at every step. So blocks are folded by themselves, then the blocks'
    totals: about linear work up to millions of values.
    """
    empty = F.array().cast(f"array<{kind}>")

    def fold(items: Column, value: Callable[[Column], Column]) -> Column:
        return F.aggregate(items, F.struct(start.alias("at"), empty.alias("before")), lambda s, x: F.struct(
            merge(s["at"], value(x)).alias("at"), F.concat(s["before"], F.array(s["at"])).alias("before")))

    def of_blocks(folded: Column) -> Column:
        ahead = fold(folded, lambda b: b["at"])["before"]
        return F.flatten(F.zip_with(ahead, folded, lambda a, b: F.transform(b["before"], lambda x: merge(a, x))))

    def blocks(v: Column) -> Column:
        last = ((F.size(v) - 1) / FOLD).cast("int")
        return F.transform(F.sequence(F.lit(0), last), lambda n: fold(F.slice(v, n * FOLD + 1, FOLD), lambda x: x))

    return let(values, lambda v: F.when(F.size(v) == 0, empty).otherwise(let(blocks(v), of_blocks)))


def _places(text: Column, pattern: str, matches: Column) -> Column:
    """(start, end, match, text since the match before) of every match, in code points.

    What lies between matches comes from splitting at the same pattern.
    """

    def all_of(found: Column, between: Column) -> Column:
        ends = running(F.transform(found, lambda m, i: F.char_length(F.get(between, i)) + F.char_length(m)),
                       "int", lambda a, b: a + b, F.lit(0))

        def place(before: Column) -> Column:
            def one(m: Column, i: Column) -> Column:
                start = F.get(before, i) + F.char_length(F.get(between, i))
                return F.struct(start.alias("start"), (start + F.char_length(m)).alias("end"), m.alias("match"),
                                F.get(between, i).alias("before"))

            return F.transform(found, one)

        return let(ends, place)

    return let(matches, lambda found: let(F.split(text, pattern, -1), lambda between: all_of(found, between)))


def _base_spans(text: Column, kind: str, matches: Column) -> Column:
    number = KINDS.index(kind)
    spans = F.transform(
        F.filter(_places(text, _PATTERNS[kind], matches), lambda m: _accepted(kind, m["match"])),
        lambda m: F.struct(F.lit(number).alias("kind"), m["start"].alias("start"), m["end"].alias("end")))
    return F.when(F.size(matches) == 0, F.array().cast(SPAN)).otherwise(spans)


def _mentions(text: Column, matches: Column) -> Column:
    def spaced(between: Column) -> Column:
        return F.trim(F.regexp_replace(between, r"[\x09-\x0D]", " "))

    def beside(words: Column, count: int, neighbour: Column) -> Column:
        """The nearest word of what lies between, or the neighbouring token when no word does."""
        word = F.substring_index(words, " ", count)
        return F.lower(F.when(word != "", word).otherwise(F.coalesce(neighbour, F.lit(""))))

    def all_of(places: Column) -> Column:
        def mention(m: Column, i: Column) -> Column:
            # without quotes and punctuation around it
            inner = F.regexp_replace(m["match"], r"^[^\p{L}\p{N}+(]++", "")
            start = m["start"] + F.char_length(m["match"]) - F.char_length(inner)
            token = F.regexp_extract(inner, r"^.*[\p{L}\p{N})]", 0)
            after = F.coalesce(F.get(places, i + 1)["before"], F.substring(text, m["end"] + 1, F.char_length(text)))
            return F.struct(
                start.alias("start"), (start + F.char_length(token)).alias("end"), token.alias("token"),
                beside(spaced(m["before"]), -1, F.get(matches, i - 1)).alias("left"),
                beside(spaced(after), 1, F.get(matches, i + 1)).alias("right"))

        return F.transform(places, mention)

    return F.when(F.size(matches) == 0, F.array().cast(MENTION)).otherwise(let(_places(text, _TOKEN, matches), all_of))


def _read_texts(docs: DataFrame) -> DataFrame:
    """key, doc_id, base spans and mentions of every whole text; ``key`` names the id and text."""
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    for kind in KINDS:
        may_be = {"email": F.contains("text", F.lit("@")), "phone": F.contains("text", F.lit("+"))}.get(
            kind, F.col("text").rlike("[0-9]"))
        found = found.withColumn(kind, F.when(
            may_be, F.regexp_extract_all("text", F.lit(_PATTERNS[kind]), F.lit(0))).otherwise(F.array().cast("array<string>")))
    found = found.withColumn("tokens", F.when(
        F.col("text").rlike("[0-9@]"), F.regexp_extract_all("text", F.lit(_TOKEN), F.lit(0))).otherwise(F.array().cast("array<string>")))
    text = F.col("text")
    return found.select(
        row_key("doc_id", "text").alias("key"), "doc_id",
        F.concat(*[_base_spans(text, kind, F.col(kind)) for kind in KINDS]).alias("base"),
        _mentions(text, F.col("tokens")).alias("mentions"))


def _all_base_spans(text: Column) -> Column:
    def spans(kind: str) -> Column:
        return let(F.regexp_extract_all(text, F.lit(_PATTERNS[kind]), F.lit(0)), lambda m: _base_spans(text, kind, m))

    return F.concat(*[spans(kind) for kind in KINDS])


def row_key(doc_id: str, text: str) -> Column:
    """128 bits that name an id with its text."""
    return F.md5(F.concat(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.lit(":"), F.col(text)))


def _shape(token: Column) -> Column:
    """Every digit as 9, every run of letters as a."""
    return F.regexp_replace(F.regexp_replace(token, "[0-9]", "9"), r"\p{L}+", "a")


def _coarse_shape(token: Column) -> Column:
    """Runs of digits as 9, 99 or 999: up to two, up to five, or more of them."""
    short = F.regexp_replace(token, "(?<![0-9])[0-9]{1,2}(?![0-9])", "9")
    middle = F.regexp_replace(short, "(?<![0-9])[0-9]{3,5}(?![0-9])", "99")
    return F.regexp_replace(F.regexp_replace(middle, "[0-9]{6,}", "999"), r"\p{L}+", "a")


def discovered_spans(read: DataFrame, rounds: int = ROUNDS, min_seeds: int = MIN_SEEDS, confident: float = CONFIDENT) -> DataFrame:
    """(key, kind, start, end) of tokens that no fixed pattern accepts and confident patterns point to.

    Tokens are those with a digit or an @. A token's patterns are its shape, and the word before it and
    the word after it, each with a coarser shape. A pattern's score
    is the mean score of its distinct tokens, one of score 0 added, and 0 below ``min_seeds``
    seeds; a token's is the best of its patterns', and 1 for seeds. A span's kind is the
    kind that most seeds of its best pattern have.
    """
    def cells(rows: DataFrame, start: str, end: str) -> DataFrame:
        return rows.withColumn("cell", F.explode(F.sequence(
            (F.col(start) / CELL).cast("int"), (F.greatest(F.col(end) - 1, F.col(start)) / CELL).cast("int"))))

    some = read.where(F.size("mentions") > 0)
    seen = some.select("key", F.explode("mentions").alias("m")).select("key", "m.*").where("token != ''").distinct()
    spans = some.select("key", F.explode("base").alias("s")).select(
        "key", F.col("s.kind").alias("kind"), F.col("s.start").alias("s_start"), F.col("s.end").alias("s_end")).distinct()
    seeds = cells(seen.select("key", "start", "end"), "start", "end").join(cells(spans, "s_start", "s_end"), ["key", "cell"]).where(
        "s_start < end AND s_end > start").groupBy("key", "start", "end").agg(F.min("kind").alias("seed"))
    seen = written(seen.join(seeds, ["key", "start", "end"], "left"), "pii-tokens")
    with_patterns = seen.withColumn("pattern", F.explode(F.array(
        F.concat(F.lit("shape "), _shape(F.col("token"))),
        *[F.concat(F.lit(name), F.regexp_replace(side, "[0-9]", "9"), F.lit(" "), _coarse_shape(F.col("token")))
          for name, side in (("after ", "left"), ("before ", "right"))])))
    edges = written(with_patterns.groupBy("pattern", "token").agg(F.max("seed").alias("seed")), "pattern-edges")

    of_pattern = edges.where("seed is not null").groupBy("pattern", "seed").agg(F.count(F.lit(1)).alias("n")).groupBy("pattern").agg(
        F.max_by("seed", "n").alias("kind"), F.sum("n").alias("seeds")).where(F.col("seeds") >= min_seeds)
    edges = written(edges.join(of_pattern, "pattern"), "pattern-edges")
    scored = edges.withColumn("score", F.col("seed").isNotNull().cast("double"))
    for _ in range(rounds):
        patterns = scored.groupBy("pattern").agg((F.sum("score") / (F.count(F.lit(1)) + 1)).alias("pattern_score"))
        tokens = edges.join(patterns, "pattern").groupBy("token").agg(
            F.max(F.struct("pattern_score", "kind")).alias("best"), F.max("seed").alias("known"))
        scored = written(edges.join(
            tokens.select("token", F.when(F.col("known").isNotNull(), 1.0).otherwise(F.col("best.pattern_score")).alias("score"),
                          F.col("best.kind").alias("best_kind")), "token"), "pattern-scores")
    chosen = scored.where((F.col("score") >= confident) & F.col("seed").isNull()).select("token", "best_kind").distinct()
    return seen.where("seed is null").join(chosen, "token").select("key", F.col("best_kind").alias("kind"), "start", "end").distinct()


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(F.sort_array(spans), lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def _extra(read: DataFrame, **settings) -> DataFrame:
    return discovered_spans(read, **settings).groupBy("key").agg(F.collect_set(F.struct("kind", "start", "end")).alias("extra"))


def find_personal_data(docs: DataFrame, **settings) -> DataFrame:
    """Per row: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans.

    The counts and ``base_sha256`` are of the fixed patterns' spans; ``spans`` has those and the
    discovered ones as ``kind:start:end``, by kind, then start (code points, end exclusive). Null
    texts count as empty and have none. Repeated rows get the same spans; contexts count distinct
    tokens, so copies add nothing. An empty table gives an empty result; extra columns are ignored.
    """
    read = written(_read_texts(docs), "pii")

    def count(k: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long").alias(f"n_{KINDS[k]}")

    return read.join(_extra(read, **settings), "key", "left").select(
        "doc_id", *[count(k) for k in range(len(KINDS))], F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
        _joined(F.concat("base", F.coalesce("extra", F.array().cast(SPAN)))).alias("spans"))


def redact_personal_data(docs: DataFrame, **settings) -> DataFrame:
    """``docs`` with every span replaced by its kind in brackets, all other columns as they came.

    Overlapping spans are replaced once, by the kind of the one that starts first. Rows without
    spans, and null texts, stay as they are.
    """
    read = written(_read_texts(docs), "pii")
    spans = read.join(_extra(read, **settings), "key", "left").select(
        "key", F.concat("base", F.coalesce("extra", F.array().cast(SPAN))).alias("spans")).where(F.size("spans") > 0).dropDuplicates(["key"])
    rows = docs.select(F.struct("*").alias("__row"), F.col("doc_id").cast("long").alias("__id"), text_or_empty().alias("__text"))
    rows = rows.select("__row", "__text", row_key("__id", "__text").alias("__key"))
    names = F.array(*[F.lit(f"[{k}]") for k in KINDS])

    def redacted(text: Column, ordered: Column) -> Column:
        """The text between the spans and the names of those that start behind all before them, joined once."""
        def cut_up(t: Column, size: int, last: Column) -> Column:
            return F.transform(F.sequence(F.lit(0), last), lambda n: F.substring(t, n * size + 1, F.lit(size)))

        # finding a place takes as long as the text before it, so places are looked for in short chunks
        large = cut_up(text, LARGE_CHUNK, (F.char_length(text) / LARGE_CHUNK).cast("int"))
        chunks = F.flatten(F.transform(large, lambda t: cut_up(t, CHUNK, F.lit(LARGE_CHUNK // CHUNK - 1))))

        def pieces(cut: Column, done: Column) -> Column:
            def between(a: Column, b: Column) -> Column:
                first, last = (a / CHUNK).cast("int"), (F.greatest(b - 1, a) / CHUNK).cast("int")
                return F.substring(F.array_join(F.slice(cut, first + 1, last - first + 1), ""), a - first * CHUNK + 1, b - a)

            def piece(s: Column, i: Column) -> Column:
                at = F.get(done, i)
                return F.when(s["start"] >= at, F.concat(between(at, s["start"]), F.get(names, s["kind"]))).otherwise(F.lit(""))

            last = F.greatest(F.element_at(done, -1), F.element_at(ordered, -1)["end"])
            tail = F.substring(text, last + 1, F.char_length(text))
            return F.concat(F.array_join(F.transform(ordered, piece), ""), tail)

        ends = running(F.transform(ordered, lambda s: s["end"]), "int", lambda a, b: F.greatest(a, b), F.lit(0))
        return F.when(F.size(ordered) == 0, text).otherwise(let(chunks, lambda cut: let(ends, lambda done: pieces(cut, done))))

    def by_start(spans: Column) -> Column:
        return F.sort_array(F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))

    # what stood beside a span may be a match of its own now, such as a number cut loose from the next
    once = let(by_start(F.col("spans")), lambda s: redacted(F.col("__text"), s))
    twice = let(once, lambda t: let(by_start(_all_base_spans(t)), lambda s: redacted(t, s)))
    text = F.when(F.col("spans").isNull(), F.col("__row.text")).otherwise(twice)
    return rows.join(spans.withColumnRenamed("key", "__key"), "__key", "left").select(
        *[(text if c == "text" else F.col("__row")[c]).alias(c) for c in docs.columns])
