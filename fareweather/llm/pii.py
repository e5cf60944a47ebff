"""Personal data: fixed forms as seeds, contexts learned from them find more.

Seeds are e-mail addresses, IP addresses, card numbers and phone numbers of a fixed
form. The word before a seed, or before another token with a digit or an at sign, is
its lexical pattern; patterns and what follows them (instances) make a graph. A
pattern is as sure of a kind as the share of its distinct instances that are of that
kind; sure patterns pass their confidence on to their other instances, which raises
other patterns, for some rounds. Tokens that follow a sure pattern are spans of its
kind; spans of the seeds stay as they are.

Everything is DataFrame functions: no Python runs on the executors. Positions are
code points, ends exclusive. A null text is empty. Rows may share an id; each gives
a row of its own. Empty tables give no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from fareweather.llm import store
from fareweather.llm.marks import free_name, with_uid

#: Kinds in their order and their forms. Possessive loops and the
#: looks behind give the same matches as plain ones, in linear time and stack.
KINDS = ("email", "ip", "card", "phone")
FORMS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A token with a digit or an at sign.
TOKEN = r"(?<!\S)\S*[0-9@]\S*"


@dataclass(frozen=True)
class Settings:
    """``confidence`` and ``support``: least share and number of a pattern's distinct
    instances that are of a kind; ``rounds`` over the graph; ``token``: least length of
    a token that a pattern may add."""

    confidence: float = 0.8
    support: float = 3.0
    rounds: int = 3
    token: int = 6


def _digits(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    figures = F.transform(F.split(F.reverse(digits), ""), lambda x, i: _figure(x, i))
    return F.aggregate(figures, F.lit(0), lambda a, x: a + x) % 10 == 0


def _figure(x: Column, i: Column) -> Column:
    value = F.coalesce(x.try_cast("int"), F.lit(0))
    double = value * 2
    return F.when(i % 2 == 1, F.when(double > 9, double - 9).otherwise(double)).otherwise(value)


def _valid(kind: Column, hit: Column) -> Column:
    count = F.length(_digits(hit))
    part = F.forall(
        F.split(hit, r"\."),
        lambda x: (F.length(F.regexp_replace(x, "^0+", "")) <= 3) & (F.coalesce(F.substring(F.concat(F.lit("000"), x), -3, 3).try_cast("int"), F.lit(999)) <= 255),
    )
    return (
        F.when(kind == "email", F.lit(True))
        .when(kind == "ip", part)
        .when(kind == "card", count.between(13, 19) & _luhn(_digits(hit)))
        .when(kind == "phone", count.between(9, 15))
        .otherwise(F.lit(True))
    )


def _hits(docs: DataFrame, kind: str, form: str, some: Column) -> DataFrame:
    """A row for each match: its place among the text's matches, the gap before it."""
    gaps, hits = F.split("text", form, -1), F.regexp_extract_all("text", F.lit(form), F.lit(0))
    found = docs.where(some).select("uid", gaps.alias("gaps"), hits.alias("hits")).where(F.size("hits") > 0)
    pairs = F.arrays_zip(F.slice("gaps", F.lit(1), F.size("hits")).alias("gap"), F.col("hits").alias("hit"))
    rows = found.select("uid", F.posexplode(pairs).alias("i", "pair"))
    return rows.select(
        "uid", F.lit(kind).alias("kind"), "i", F.col("pair.hit").alias("hit"),
        F.length("pair.gap").alias("gap"),
        F.lower(F.regexp_extract("pair.gap", r"(\S{1,64})\s+$", 1)).alias("pattern"),
    )


def _entities(docs: DataFrame) -> DataFrame:
    """Valid seeds and tokens with their places; a token knows the seed it overlaps."""
    digit, at = F.col("text").rlike("[0-9]"), F.contains("text", F.lit("@"))
    needs = {"email": at, "ip": digit, "card": digit, "phone": F.contains("text", F.lit("+")) & digit}
    rows = _hits(docs, "token", TOKEN, digit | at)
    for kind in KINDS:
        rows = rows.unionByName(_hits(docs, kind, FORMS[kind], needs[kind]))
    rows = rows.dropDuplicates(["uid", "kind", "i"]).repartition("uid")
    order = W.partitionBy("uid", "kind").orderBy("i")
    rows = rows.withColumn("end", F.sum(F.col("gap") + F.length("hit")).over(order)).withColumn("start", F.col("end") - F.length("hit"))
    # Signs at either end of a token are not part of it.
    token = F.col("kind") == "token"
    core = F.regexp_extract("hit", r"^[^\p{L}\p{N}]*+(.*?)[^\p{L}\p{N}]*$", 1)
    head = F.length(F.regexp_extract("hit", r"^[^\p{L}\p{N}]*", 0))
    rows = (
        rows.where(_valid(F.col("kind"), F.col("hit")))
        .withColumn("core", F.when(token, core).otherwise(F.col("hit")))
        .withColumn("start", F.when(token, F.col("start") + head).otherwise(F.col("start")))
        .withColumn("end", F.col("start") + F.length("core"))
        .where("end > start")
    )
    seed = ~token
    place = W.partitionBy("uid").orderBy("start", F.when(token, 1).otherwise(0), "end", "kind")
    ahead = place.rowsBetween(W.unboundedPreceding, W.currentRow)
    later = place.rowsBetween(W.currentRow, W.unboundedFollowing)
    near = F.max(F.when(seed, F.struct("end", "kind"))).over(ahead)
    after = F.first(F.when(seed, F.struct("start", "kind")), ignorenulls=True).over(later)
    rows = rows.withColumn("near", near).withColumn("after", after)
    own = F.when(F.col("near.end") > F.col("start"), F.col("near.kind")).when(F.col("after.start") < F.col("end"), F.col("after.kind"))
    return rows.select("uid", "kind", "start", "end", "core", "pattern", F.when(token, own).otherwise(F.col("kind")).alias("own"))


def _patterns(entities: DataFrame, s: Settings) -> DataFrame:
    """(pattern, found, confidence) of the sure patterns, after some rounds."""
    edges = store.written(
        entities.where("pattern != '' and (kind != 'token' or own is null)")
        .groupBy("pattern", "core").agg(F.max("own").alias("own")), "edges",
    )
    total = edges.groupBy("pattern").agg(F.count("*").alias("total"))
    seeds = edges.where("own is not null").groupBy("core").agg(F.max("own").alias("found")).withColumn("score", F.lit(1.0))
    known, sure = seeds, None
    for _ in range(s.rounds):
        votes = edges.select("pattern", "core").join(known, "core").groupBy("pattern", "found").agg(F.sum("score").alias("votes"))
        sure = (
            votes.where(F.col("votes") >= s.support).join(total, "pattern")
            .withColumn("confidence", F.col("votes") / F.col("total"))
            .where(F.col("confidence") >= s.confidence).select("pattern", "found", "confidence")
        )
        more = edges.where("own is null").join(sure, "pattern").groupBy("core").agg(F.max(F.struct("confidence", "found")).alias("best"))
        more = more.select("core", F.col("best.found"), F.col("best.confidence").alias("score")).join(seeds.select("core"), "core", "left_anti")
        known = seeds.union(more)
    return sure


def spans(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(uid, kind, start, end, base) of all spans in ``docs`` that have a uid."""
    entities = store.written(_entities(docs), "entities")
    base = entities.where("kind != 'token'").select("uid", "kind", "start", "end", F.lit(True).alias("base"))
    free = entities.where("kind = 'token' and own is null").where(F.length("core") >= settings.token)
    more = free.join(_patterns(entities, settings), "pattern").groupBy("uid", "start", "end").agg(
        F.max(F.struct("confidence", "found")).alias("best")
    )
    return base.unionByName(more.select("uid", F.col("best.found").alias("kind"), "start", "end", F.lit(False).alias("base")))


def _rank(kind: Column) -> Column:
    return F.array_position(F.array(*map(F.lit, KINDS)), kind)


def _joined(array: Column) -> Column:
    def text(x: Column) -> Column:
        return F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))

    return F.array_join(F.transform(array, text), ",")


def report(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): counts of the seeds, and the lists
    ``base`` and ``spans`` of kind:start:end, comma-joined."""
    docs = with_uid(docs)
    span = F.struct(_rank(F.col("kind")).alias("rank"), "start", "end", "kind", "base")
    found = spans(docs.select("uid", "text"), settings).groupBy("uid").agg(F.sort_array(F.collect_list(span)).alias("all"))
    none = F.lit([]).cast("array<struct<rank:bigint,start:bigint,end:bigint,kind:string,base:boolean>>")
    out = docs.select("uid", "doc_id").join(found, "uid", "left").withColumn("all", F.coalesce("all", none))
    out = out.withColumn("seeds", F.filter("all", lambda x: x["base"]))

    def count(kind: str) -> Column:
        return F.size(F.filter("seeds", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(kind) for kind in KINDS]
    return out.select("doc_id", *counts, _joined(F.col("seeds")).alias("base"), _joined(F.col("all")).alias("spans"))


def redacted(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """``docs`` with each span of its text replaced by its kind in brackets."""
    own, marks = free_name(docs, "_uid"), free_name(docs, "_spans")
    keyed = docs.withColumn(own, F.xxhash64(F.col("doc_id").cast("long"), F.coalesce("text", F.lit(""))))
    found = spans(keyed.select(F.col(own).alias("uid"), F.coalesce("text", F.lit("")).alias("text")), settings)
    order = W.partitionBy("uid").orderBy("start", "end", "kind")
    reached = F.coalesce(F.max("end").over(order.rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    apart = (
        found.withColumn("reached", reached).where(F.col("end") > F.col("reached"))
        .withColumn("start", F.greatest("start", "reached"))
        .groupBy("uid").agg(F.sort_array(F.collect_list(F.struct("start", "end", "kind", "reached"))).alias(marks))
    )
    # Text between the spans, and after the last.
    text = F.col("text")
    pieces = F.transform(marks, lambda x: F.concat(text.substr((x["reached"] + 1).cast("int"), (x["start"] - x["reached"]).cast("int")), F.lit("["), x["kind"], F.lit("]")))
    last = F.element_at(marks, -1)["end"]
    tail = text.substr((last + 1).cast("int"), F.length(text))
    new = F.when(F.col(marks).isNotNull(), F.concat(F.array_join(pieces, ""), tail)).otherwise(text)
    joined = keyed.join(apart.withColumnRenamed("uid", own), own, "left")
    return joined.withColumn("text", new).select(*docs.columns)
