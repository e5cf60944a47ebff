import zlib

import numpy as np
from tokenizers import Tokenizer

from fareweather.llm import packing
from fareweather.llm.queries import tokenizer_path

ODD = [
    (1, "It's THE <|endoftext|>x don't<|starttext|> we'll,\"q\" 12a3 é.É ÄÖ×÷2 áb ≠  x y"),
    (2, None), (3, ""), (None, "no id"), (3, "same id"), (3, "same id"), (4, "x" * 9000), (5, "中文 \U0001f600"),
]


def check(rows, out, size=2048):
    tool = Tokenizer.from_file(tokenizer_path())
    want = sorted(
        (str(i), tuple(tool.encode(t or "", add_special_tokens=False).ids + [1])) for i, t in rows
    )
    starts = {}
    for r in sorted(out, key=lambda r: (r["start"])):
        ids = np.frombuffer(bytes(r["ids"]), "<u4").tolist()
        assert len(ids) == r["length"] > 0
        starts.setdefault(str(r["doc_id"]), []).append((r["start"], r["doc_tokens"], ids))
    if len(starts) == len(rows):  # ids are unique
        got = []
        for key, parts in starts.items():
            at, own = 0, []
            for start, total, ids in parts:
                assert start == at
                at += len(ids)
                own += ids
            assert at == total
            got.append((key, tuple(own)))
        assert sorted(got) == want
    assert sum(r["length"] for r in out) == sum(len(ids) for _, ids in want)
    windows = {}
    for r in out:
        windows.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in windows.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= size
    return len(windows)


def test_every_id_once_and_little_padding(spark, docs_of, sample_rows):
    out = packing.pack(docs_of(sample_rows, 5), tokenizer_path()).collect()
    n = check(sample_rows, out)
    assert sum(r["length"] for r in out) >= 0.98 * 2048 * (n - 1)


def test_odd_texts_and_ids(docs_of):
    check(ODD, packing.pack(docs_of(ODD), tokenizer_path()).collect())
    unique = [(k, t) for k, (_, t) in enumerate(ODD)]
    check(unique, packing.pack(docs_of(unique), tokenizer_path(), size=16, windows=2).collect(), 16)


def test_many_small_tasks_are_merged_in_rounds(docs_of, sample_rows):
    rows = sample_rows[:60]
    out = packing.pack(docs_of(rows, 9), tokenizer_path(), fan_in=2, windows=3).collect()
    check(rows, out)


def test_empty_table(docs_of):
    assert packing.pack(docs_of([]), tokenizer_path()).count() == 0
