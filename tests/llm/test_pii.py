import re

from fareweather.llm import pii

#: The forms as they are asked for.
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(s):
    total = 0
    for i, c in enumerate(reversed(s)):
        v = int(c) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def base(text):
    out = []
    for kind, form in PLAIN.items():
        for m in re.finditer(form, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            good = {
                "email": True, "ip": all(int(x) <= 255 for x in m[0].split(".")) if kind == "ip" else False,
                "card": 13 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15,
            }[kind]
            if good:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return ",".join(out)


TEXTS = [
    "mail a.b%c+d-e@x-y.co.uk, and x@y or p@q.r_s@t.u é@b.c a@b.c@d.e .@-.-", "1.2.3.4 256.1.1.1 001.02.3.255 1.2.3.4.5.6.7.8 12.3.4 0000255.1.1.1 9999999999999.1.1.1",
    "4111 1111 1111 1111 and 4111-1111-1111-1112 41111111 11111111 4 4  5 5500005555555559x0", "+4 (262) 555-3752. +1 2 +12-345.678 (90) +123456789012345678 ++49 30 1234567",
    "é😀 a@b.cc 😀+49 30 1234567 ü 10.0.0.1", "", None, "9" * 30_000, "a" * 30_000, "1 " * 9000, "+" * 3000 + "1" * 20, "@." * 3000, "a@b.c " * 3000,
]


def test_base_spans_are_exact(docs_of):
    rows = list(enumerate(TEXTS))
    got = {r["doc_id"]: r for r in pii.report(docs_of(rows)).collect()}
    for i, t in rows:
        want = base(t)
        assert got[i]["base"] == want, i
        for kind in pii.KINDS:
            assert got[i][f"n_{kind}"] == sum(x.startswith(kind) for x in want.split(","))


def contexts():
    rows = [(k, f"call me, tel: +49 30 123456{k:02d} or write e-mail: u{k}@mail.example ok") for k in range(12)]
    rows += [(50, "tel: 030-123-4567 now"), (51, "e-mail: john(at)mail9"), (52, "other: 030-123-4567"), (53, "of 12345678 of 7654321")]
    return rows


def test_contexts_find_more(docs_of):
    got = {r["doc_id"]: r for r in pii.report(docs_of(contexts())).collect()}
    assert got[50]["spans"] == "phone:5:17" and got[50]["base"] == "" and got[50]["n_phone"] == 0
    assert got[51]["spans"] == "email:8:21"
    assert got[52]["spans"] == got[53]["spans"] == ""
    assert got[3]["spans"] == got[3]["base"] == base(contexts()[3][1])


def test_repeated_rows_and_missing_ids(docs_of):
    rows = [*contexts(), *contexts()[:3], (None, "x 10.0.0.1"), (None, "10.0.0.1")]
    out = sorted(str((r["doc_id"], r["base"])) for r in pii.report(docs_of(rows)).collect())
    assert out == sorted(str((i, base(t))) for i, t in rows)


def test_redaction_keeps_all_else(docs_of):
    rows = [(1, "é a@b.cc, 4111 1111 1111 1111!"), (2, None), (3, "none"), (4, "+4111 1111 1111 1111 end"), (5, "")]
    docs = docs_of(rows)
    out = pii.redacted(docs)
    assert out.columns == docs.columns
    got = {r["doc_id"]: r["text"] for r in out.collect()}
    assert got == {1: "é [email], [card]!", 2: None, 3: "none", 4: got[4], 5: ""}
    assert got[4].endswith(" end") and "1111" not in got[4]


def test_no_python_in_the_plan(docs_of):
    text = pii.report(docs_of(contexts()))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Arrow" not in text


def test_empty_table(docs_of):
    assert pii.report(docs_of([])).count() == 0 and pii.redacted(docs_of([])).count() == 0
