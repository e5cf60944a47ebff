"""Language by compression: the dictionary that makes a text smallest names it.

For each label a raw-content dictionary is made of a bounded sample of its rows; of
a long text pieces spread over it are taken. A text is encoded with every dictionary; the smallest result wins, and a
narrow lead over the second is a rejection.

A text that is null or has no letter is ``und`` with score 0 and rejected. Rows
without a label teach nothing. Ties go to the more frequent language, then by name.
With no labelled rows everything is ``und``. Extra columns do not matter.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

UNKNOWN = "und"
_LETTER = re.compile(r"[^\W\d_]")
_SIGN = re.compile(r"[^\w\s]|[\d_]")

SCHEMA = "lang_pred string, score double, margin double, rejected boolean"


@dataclass(frozen=True)
class Settings:
    """``languages``: if given, only so many, the most frequent; ``rows`` and
    ``row_bytes``: sampled rows of a language, and of a longer text ``pieces`` pieces
    of so many bytes together; ``dictionary_bytes``: of each dictionary, and
    ``all_bytes`` of all: with more languages than fit, all of them get smaller
    dictionaries of smaller pieces; ``level``: of the encoder. Texts that shrink below ``fine_bytes``,
    where single bytes matter, are encoded at ``fine_levels`` with each of ``fine_parts``
    parts of a dictionary, and the sizes averaged. ``block_bytes``: a longer text is
    encoded in blocks of so many, each beginning with the dictionary, and the sizes are
    summed: else a long text becomes its own dictionary and the lead fades.
    ``held``: languages up to which encoders keep their buffers. ``margin``: the least
    lead, as a share of the smallest size, that is not narrow."""

    languages: int | None = None
    rows: int = 300
    row_bytes: int = 16_384
    pieces: int = 8
    dictionary_bytes: int = 131_072
    all_bytes: int = 8_388_608
    level: int = 3
    fine_levels: tuple[int, ...] = (3, 19)
    fine_parts: int = 4
    fine_bytes: int = 250
    block_bytes: int = 65_536
    held: int = 64
    margin: float = 0.002


@dataclass(frozen=True)
class Model:
    names: tuple[str, ...]
    contents: tuple[bytes, ...]
    settings: Settings


def fit(docs: DataFrame, label: str = "lang", settings: Settings = Settings()) -> Model:
    """Dictionaries from the rows of ``docs`` with a label; needs doc_id and text."""
    s = settings
    given = docs.where(F.col(label).isNotNull() & F.col("text").isNotNull()).select(
        F.col(label).alias("_label"), F.col("text").alias("_text"), F.xxhash64("doc_id", F.lit(4)).alias("_draw"), F.col("doc_id").alias("_id")
    )
    drawn = W.partitionBy("_label").orderBy("_draw")
    # Only the draw is kept of each row, and each task hands on its first rows only.
    first = given.select("_label", "_draw").withColumn("_rank", F.row_number().over(drawn)).where(F.col("_rank") <= s.rows)
    counts = given.groupBy("_label").count()
    # One row a language, as in the model.
    found = counts.join(first.groupBy("_label").agg(F.max("_draw").alias("_last")), "_label").orderBy(F.desc("count"), "_label").collect()
    found = found if s.languages is None else found[: s.languages]
    names = [r["_label"] for r in found]
    size = min(s.dictionary_bytes, s.all_bytes // max(len(names), 1))
    row_bytes = max(s.row_bytes * size // s.dictionary_bytes, 64)
    last = docs.sparkSession.createDataFrame([(r["_label"], r["_last"]) for r in found], given.select("_label", F.col("_draw").alias("_last")).schema)
    ranked = W.partitionBy("_label").orderBy("_draw", "_id", "_text")

    def joined(rows: pd.DataFrame) -> pd.DataFrame:
        texts = rows.sort_values("_rank")["_text"]
        return pd.DataFrame({"_label": rows["_label"].iloc[:1], "_content": [b"".join(map(_plain, texts))[:size]]})

    sample = (
        given.join(F.broadcast(last), "_label").where(F.col("_draw") <= F.col("_last"))
        .withColumn("_text", _spread(F.col("_text"), row_bytes, s.pieces))
        .withColumn("_rank", F.row_number().over(ranked))
        .where(F.col("_rank") <= s.rows)
    )
    # Bounded: a group is the sampled rows of a language, each of bounded length.
    made = sample.select("_label", "_rank", "_text").groupBy("_label").applyInPandas(joined, f"_label {given.schema['_label'].dataType.simpleString()}, _content binary")
    contents = {r["_label"]: bytes(r["_content"]) for r in made.collect()}
    return Model(tuple(names), tuple(contents[n] for n in names), s)


def _spread(text: Column, size: int, parts: int) -> Column:
    """The text, or of one over ``size`` bytes up to ``parts`` pieces spread over it."""
    parts = max(min(parts, size // 256), 1)
    width = size // (4 * parts)  # characters, of up to four bytes
    step = (F.length(text) - width) / max(parts - 1, 1)
    cut = [text.substr((step * k).cast("int") + 1, F.lit(width)) for k in range(parts)]
    return F.when(F.octet_length(text) <= size, text).otherwise(F.concat_ws(" ", *cut))


def _plain(text: str) -> bytes:
    """Lower-case words alone: signs and digits tell nothing and part no word."""
    return (" " + " ".join(_SIGN.sub("", text.lower()).split()) + " ").encode("utf-8", "replace")


class _Encoders:
    def __init__(self, model: Model):
        import zstandard

        def encoder(content: bytes, level: int):
            given = None
            if content:
                given = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                given.precompute_compress(level=level)

            def made():
                return zstandard.ZstdCompressor(
                    level=level, dict_data=given, write_checksum=False, write_content_size=False, write_dict_id=False
                )

            # An encoder keeps its buffers: of many languages only the dictionaries stay.
            return made().compress if held else lambda data: made().compress(data)

        s = model.settings
        held = len(model.names) <= s.held
        self.model = model
        self.whole = [[encoder(c, s.level)] for c in model.contents]
        self.fine = [
            [encoder(c[k * len(c) // s.fine_parts : (k + 1) * len(c) // s.fine_parts], v) for k in range(s.fine_parts) for v in s.fine_levels]
            for c in model.contents
        ]

    def __call__(self, text: str | None) -> tuple[str, float, float, bool]:
        m, s = self.model, self.model.settings
        if not text or not m.names or not _LETTER.search(text):
            return UNKNOWN, 0.0, 0.0, True
        data = _plain(text)
        blocks = [data[k : k + s.block_bytes] for k in range(0, len(data), s.block_bytes)]
        for encoders in (self.whole, self.fine):
            sizes = [sum(len(e(b)) for b in blocks for e in own) / len(own) for own in encoders]
            if min(sizes) >= s.fine_bytes:
                break
        order = sorted(range(len(sizes)), key=sizes.__getitem__)
        best = sizes[order[0]]
        score = 1.0 / sum(2.0 ** max(best - x, -1000.0) for x in sizes)
        margin = (sizes[order[1]] - best) / best if len(order) > 1 else 1.0
        return m.names[order[0]], score, margin, margin < s.margin


def predictor(spark: SparkSession, model: Model):
    """A function from a text column to a struct of SCHEMA."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf(SCHEMA)
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        encode = _Encoders(shared.value)
        for texts in batches:
            yield pd.DataFrame([encode(t) for t in texts], columns=["lang_pred", "score", "margin", "rejected"])

    return predict


def held_out(parts: int, rest: int, key: str = "doc_id") -> Column:
    """Rows whose crc32 of the id as text leaves ``rest``; false without an id."""
    return F.coalesce(F.crc32(F.col(key).cast("string")) % parts == rest, F.lit(False))
