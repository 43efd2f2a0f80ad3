"""Operator 10: secret scans with multipart credential linking, DataFrame functions only.

Patterns are found with ``regexp_extract_all``; their places follow from ``split`` by the same
pattern, because pieces and matches alternate, so running lengths give code-point offsets.  A
credential often has parts that prove little alone: an access identifier, a secret, an endpoint.
Weak candidates for each part are found too, and each is the centre of a scope of ``scope`` code
points to both sides, from its start and from its end.  The interval join of parts and scopes runs
over the candidates of a document in order: the furthest end of each part so far and the next start
of each tell which kinds of part lie within the scope, so no pair is ever made.  A weak candidate is reported only if both other kinds of part, or a sure one of a
complementary kind, stand in its scope.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import columns_of, free_names, resolved

#: Fixed patterns of the base spans, in their order: (kind, pattern, least length, group measured).
BASE = (
    ("assign", r"(?i)(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 6, 2),
    ("access", r"AKIA[A-Z0-9]+", 20, 0),
    ("hex", r"[0-9a-f]{24,}", 24, 0),
)
#: Candidates that prove little alone: (kind, pattern, part of a credential).
WEAK = (
    ("weak_id", r"(?i)\b(?:client_?id|user(?:name)?|login|account|key_?id)[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9@._-]{3,}", "id"),
    ("weak_key", r"\b(?=[A-Za-z+/_-]*[0-9])(?=[A-Z0-9a-z+/_-]*[A-Z])(?=[A-Z0-9+/_-]*[a-z])[A-Za-z0-9+/_-]{20,}={0,2}", "secret"),
    ("weak_url", r"\b(?:https?|jdbc:[a-z]+|postgres(?:ql)?|mysql|mongodb|redis|amqps?|s3|ftp|ssh)://[^\s\"'<>]{3,}", "endpoint"),
    ("weak_host", r"(?i)\b(?:host|endpoint|server|region)[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9._-]{3,}", "endpoint"),
)
KINDS = tuple(k for k, *_ in BASE) + tuple(k for k, *_ in WEAK)
#: The part of a credential that a base kind is.
PART = {"assign": "secret", "access": "id", "hex": "secret"} | {k: p for k, _, p in WEAK}
PARTS = ("id", "secret", "endpoint")


def matches(text: Column, pattern: str, kind: int, least: int = 0, group: int = 0) -> Column:
    """Array of (kind, nth, gap, size, passes) of the leftmost matches: the letters between a match
    and the one before it, its own letters, and whether its ``group`` has ``least`` of them."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    measured = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else found
    gaps = F.split(text, pattern, -1)  # one more than matches
    each = F.transform(F.arrays_zip(found.alias("m"), measured.alias("g"), F.slice(gaps, 1, F.size(found)).alias("b")), lambda x, i: F.struct(
        F.lit(kind).alias("kind"), i.alias("nth"), F.length(x["b"]).alias("gap"), F.length(x["m"]).alias("size"), (F.length(x["g"]) >= least).alias("passes")))
    none = F.array().cast("array<struct<kind:int,nth:int,gap:int,size:int,passes:boolean>>")
    return F.when(text.rlike(pattern), each).otherwise(none)


def find_secrets(docs: DataFrame, scope: int = 200) -> DataFrame:
    """Per row of ``docs``: doc_id, row and ``found``, the array of (start, kind, end, weak) in order.

    ``kind`` is an index into ``KINDS``; offsets are code points, the end exclusive.  Weak
    candidates that overlap a base span are dropped, since the base span already reports them.
    Null and empty texts have no spans; rows that repeat doc_id and text are treated alike, each of
    them staying; a long text is read whole; an empty table gives no rows; other columns are not read.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    keyed = docs.select("doc_id", F.xxhash64(text).alias("row"), text.alias("text"))
    every = F.concat(*[matches(F.col("text"), p, i, least, group) for i, (_, p, least, group) in enumerate(BASE)],
                     *[matches(F.col("text"), p, len(BASE) + i) for i, (_, p, _) in enumerate(WEAK)])
    rows = keyed.select("doc_id", "row", every.alias("every")).withColumn("n", F.monotonically_increasing_id())
    # one row a match, and one for a text without any; running sums over a kind's matches are places
    apart = rows.select("n", "doc_id", "row", F.explode_outer("every").alias("x")).select("n", "doc_id", "row", "x.*").repartition("n")
    end = F.sum(F.col("gap") + F.col("size")).over(Window.partitionBy("n", "kind").orderBy("nth").rowsBetween(Window.unboundedPreceding, 0))
    single = apart.withColumn("to", end.cast("int")).select(
        "n", "doc_id", "row", "kind", F.when(F.col("passes"), F.col("to") - F.col("size")).alias("start"), F.when(F.col("passes"), F.col("to")).alias("end"))
    part = F.element_at(F.array(*[F.lit(PARTS.index(PART[k])) for k in KINDS]), F.col("kind") + 1)
    sure = F.col("kind") < len(BASE)
    marked = single.withColumns({"part": part, "sure": sure})
    before = Window.partitionBy("n").orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy("n").orderBy(F.desc("start"), F.desc("kind")).rowsBetween(Window.unboundedPreceding, -1)

    def within(of: Column) -> Column:
        """Whether an interval of ``of`` has a gap of at most ``scope`` to this one."""
        return F.coalesce(F.max(F.when(of, F.col("end"))).over(before) >= F.col("start") - scope, F.lit(False)) | F.coalesce(
            F.min(F.when(of, F.col("start"))).over(after) <= F.col("end") + scope, F.lit(False))

    near = marked.withColumns({f"near{i}": within(F.col("part") == i) for i in range(3)} | {
        f"sure{i}": within((F.col("part") == i) & F.col("sure")) for i in range(3)} | {
        "covered": (F.coalesce(F.max(F.when(F.col("sure"), F.col("end"))).over(before), F.lit(-1)) > F.col("start"))
        | (F.coalesce(F.min(F.when(F.col("sure"), F.col("start"))).over(after), F.lit(2**31 - 1)) < F.col("end"))})
    complementary = F.lit(False)
    for i in range(3):
        others = [j for j in range(3) if j != i]
        complementary = complementary | ((F.col("part") == i) & (
            (F.col(f"near{others[0]}") & F.col(f"near{others[1]}")) | F.col(f"sure{others[0]}") | F.col(f"sure{others[1]}")))
    kept = near.withColumn("span", F.when(
        F.col("start").isNotNull() & (F.col("sure") | (complementary & ~F.col("covered"))),
        F.struct("start", "kind", "end", (~F.col("sure")).alias("weak"))))
    return kept.groupBy("n").agg(
        F.first("doc_id").alias("doc_id"), F.first("row").alias("row"),
        F.array_sort(F.collect_list("span")).alias("found")).drop("n")  # collect_list leaves nulls out


def joined(found: Column) -> Column:
    """kind:start:end by start, then kind, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(found, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def report(docs: DataFrame, scope: int = 200) -> DataFrame:
    """doc_id, counts of the base kinds, the digest of the base spans and all spans as a string."""
    found = F.col("found")
    base = F.filter(found, lambda s: ~s["weak"])

    def count(kind: int) -> Column:
        return F.size(F.filter(found, lambda s: s["kind"] == kind)).cast("long")

    return find_secrets(docs, scope).select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(joined(base), 256).alias("base_sha256"), joined(found).alias("spans"))


def redact(docs: DataFrame, scope: int = 200, mark: str = "[secret]") -> DataFrame:
    """``docs`` with every reported span of ``text`` replaced by ``mark``; rows and columns stay."""
    text = F.coalesce(F.col("text"), F.lit(""))
    number, row, found_ = free_names(docs, "__id", "__row", "__found")
    keyed = docs.withColumns({number: F.coalesce(resolved("doc_id").cast("string"), F.lit("\0")), row: F.xxhash64(text)})
    found = find_secrets(docs, scope).where(F.size("found") > 0).select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("\0")).alias(number), F.col("row").alias(row),
        F.col("found").alias(found_)).dropDuplicates([number, row])
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    body = F.aggregate(
        F.col(found_), start,
        lambda acc, s: F.when(
            s["start"] >= acc["at"],
            F.struct(s["end"].alias("at"), F.concat(acc["out"], F.col("text").substr(acc["at"] + 1, s["start"] - acc["at"]), F.lit(mark)).alias("out"))
        ).otherwise(F.struct(F.greatest(acc["at"], s["end"]).alias("at"), acc["out"].alias("out"))),
        lambda acc: F.concat(acc["out"], F.col("text").substr(acc["at"] + 1, F.length("text"))))
    return keyed.join(found, [number, row], "left").withColumn(
        "text", F.when(F.col(found_).isNull(), F.col("text")).otherwise(body)).select(*columns_of(docs))
