import hashlib
import random
import re

from pyspark.sql import functions as F

from kinfold.llm import pii

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def good(kind, v):
    d = [int(c) for c in v if c in "0123456789"]
    if kind == "ip":
        return all(int(p) <= 255 for p in v.split("."))
    if kind == "card":
        return 12 <= len(d) <= 19 and sum(x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for i, x in enumerate(d[::-1])) % 10 == 0
    return kind != "phone" or 9 <= len(d) <= 15


def plain(text):
    found = [(m.start(), k, m.end(), kind) for k, (kind, p) in enumerate(PLAIN.items()) for m in re.finditer(p, text or "") if good(kind, m[0])]
    return [f"{kind}:{a}:{b}" for a, _, b, kind in sorted(found)]


def spans(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = df.select("doc_id", pii.base_spans(F.coalesce("text", F.lit(""))).alias("s")).collect()
    return {r.doc_id: [f"{x.kind}:{x.start}:{x.end}" for x in r.s] for r in out}


def test_base_spans_against_plain_patterns(spark):
    r = random.Random(1)
    texts = ["".join(r.choice("ab1.@-_% +(") for _ in range(r.randint(0, 50))) for _ in range(800)]
    texts += ["".join(r.choice("0123456789 -.") for _ in range(r.randint(0, 60))) for _ in range(800)]
    texts += [None, "", "é 4111 1111 1111 1111 ü x@y.zé 1.2.3.4.5.6.7.8 256.1.1.1", "a@b.c_d@e.f", "a@b.c..d@e.f", "+49 (30) 123-4567", "𝒳 a@b.co 001.2.3.4", "4111-1111-1111-1111-4", "a@b" + ".c" * 3000, "1 " * 4000]
    got = spans(spark, texts)
    for i, t in enumerate(texts):
        assert got[i] == plain(t), t


def test_long_runs_cost_no_stack(spark):
    got = spans(spark, ["a" * 300_000, "1" * 300_000, "+1" + "2" * 200_000, "x@" + "y." * 100_000 + "z"])
    assert got[0] == got[1] == got[2] == [] and got[3] == ["email:0:200003"]


def corpus():
    r = random.Random(2)
    words = [f"word{i % 97}x" for i in range(97)]
    fill = lambda n: " ".join(re.sub(r"\d", lambda m: "abcdefghij"[int(m[0])], r.choice(words)) for _ in range(n))
    rows = [(i, fill(120)) for i in range(150)]
    for i in range(6):
        rows.append((1000 + i, f"{fill(40)} Zyqvandel {fill(2)} jo@corp.example {fill(40)}"))
    for i in range(6):  # copies: one context
        rows.append((2000 + i, "Copied Harlequin text al@corp.example stands here always"))
    return rows


def test_terms_that_give_an_entity_away(spark):
    rows = [*corpus(), (3000, None), (1000, corpus()[150][1])]
    df = spark.createDataFrame([(i, t, "c") for i, t in rows], "doc_id long, text string, code string")
    got = pii.find(df).collect()
    assert len(got) == len(rows)
    text = dict(rows)
    for x in got:
        terms = [text[x.doc_id][s.start : s.end] for s in x.all_spans if s.kind == "term"]
        assert terms == (["Zyqvandel"] if 1000 <= x.doc_id < 2000 else [])
        base = ",".join(f"{s.kind}:{s.start}:{s.end}" for s in x.spans)
        assert base == ",".join(plain(text[x.doc_id]))
    out = {r.doc_id: r for r in pii.sanitize(df).collect()}
    assert out[3000].text is None and out[1000].code == "c"
    assert "[TERM]" in out[1001].text and "[EMAIL]" in out[1001].text and "Zyqvandel" not in out[1001].text
    assert out[2000].text == "Copied Harlequin text [EMAIL] stands here always" and out[5].text == text[5]


def test_terms_are_marked_wherever_they_stand(spark):
    far = corpus()[0][1]
    w = far.split()[0]
    rows = corpus()[:150]
    rows += [(1000, f"Qo {far} {w} Qo X77 bo@corp.example {w}"), (1001, f"qo's X77 bo@corp.example {far} {far} {w} QO"), (1002, "Qo alone"), (None, f"{w} 'Qo' {far} bo@corp.example")]
    rows += [(1003, f"Melzburg {far} Melzburg lu@corp.example")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.text for r in pii.sanitize(df).collect()}
    assert got[1000] == f"[TERM] {far} {w} [TERM] [TERM] [EMAIL] {w}"
    assert got[1001] == f"[TERM]'s [TERM] [EMAIL] {far} {far} {w} [TERM]" and got[1002] == "Qo alone"
    assert got[None] == f"{w} '[TERM]' {far} [EMAIL]" and got[1003] == f"[TERM] {far} [TERM] [EMAIL]" and got[7] == rows[7][1]


def plain_pmi(rows):
    """(entity, term) -> PMI / IC, by loops over all contexts of all texts."""
    import math
    from collections import Counter, defaultdict

    word = re.compile(r"[^\W_][^\W_]+")
    contexts, together, n, words = defaultdict(set), defaultdict(set), Counter(), 0
    for _, text in rows:
        text = text or ""
        words += len(text.split())
        n.update(word.findall(text.lower()))
        found = [(int(a), int(b), kind) for kind, a, b in (x.split(":") for x in plain(text))]
        for a, b, kind in found:
            value = text[a:b]
            entity = f"{kind}:" + (re.sub("[^0-9]", "", value) if kind in ("card", "phone") else value.lower())
            begin, end = max(a - 48, 0), min(b + 48, len(text))
            left, tail = text[begin:a], text[b:end] if end == len(text) else re.sub(r"\S+$", "", text[b:end])
            head = len(re.match(r"\S*", left)[0]) if begin else 0
            contexts[entity].add((left, tail))
            for part, at in ((left[head:], begin + head), (tail, b)):
                for m in word.finditer(part):
                    if not any(at + m.start() < y and x < at + m.end() for x, y, _ in found):
                        together[entity, m[0].lower()].add((left, tail))
    seen = {e: len({c for (f, _), cs in together.items() if f == e for c in cs}) for e in contexts}
    windows, out = max(words / pii.WINDOW_WORDS, 1), {}
    for (e, t), cs in together.items():
        p = min(1, n[t] / windows)
        pmi = math.log((len(cs) + pii.PRIOR * p) / (seen[e] + pii.PRIOR) / p)
        out[e, t] = pmi / -math.log(min(0.5, seen[e] / windows))
    return out


def test_pmi_against_brute_force(spark):
    r = random.Random(7)
    words = [f"{a}{b}" for a in ("al", "bo", "ci", "du", "Ed") for b in ("ma", "né", "pos", "rix")]
    people = ["jo@corp.example", "10.2.3.4", "+49 30 1234 5678", "4111 1111 1111 1111"]
    rows = []
    for i in range(60):
        text = " ".join(r.choice(words) for _ in range(r.randint(5, 60))).split()
        for _ in range(r.randint(0, 3)):
            k = r.randrange(len(people))
            text.insert(r.randrange(len(text)), people[k] + r.choice(["", ",", " Kenn" + "abcd"[k]]))
        rows.append((i, " ".join(text)))
    rows += [(70, None), (71, rows[3][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = plain_pmi(rows)
    got = {(x.entity, x.term): x.ratio for x in pii.disclosing(df, pii.scanned(df), threshold=-100.0).collect()}
    assert got.keys() == want.keys() and len(got) > 40
    for k, v in want.items():
        assert abs(got[k] - v) < 1e-9, k


def test_thousands_of_spans_in_a_text(spark):
    import time

    rows = [(1, " ".join(f"word{i} a{i}@b.example, 10.0.{i % 250}.7" for i in range(8000))), (2, "a5@b.example word5")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    begin = time.time()
    got = {x.doc_id: x for x in pii.find(df).select("doc_id", F.size("spans").alias("n"), F.size("all_spans").alias("m")).collect()}
    assert got[1].n == 16000 and got[1].m > 16000 and got[2].n == 1
    assert time.time() - begin < 60


def test_overlapping_spans_and_empty_tables(spark):
    df = spark.createDataFrame([(1, "call +49 30 1234 5678.1.2.3 now")], "doc_id long, text string")
    assert "1234" not in pii.sanitize(df).first()["text"]
    assert pii.find(df.where("false")).count() == 0 and pii.sanitize(df.where("false")).count() == 0


def test_digest_of_nothing(spark):
    row = spark.createDataFrame([(1, "")], "doc_id long, text string").withColumn("spans", pii.base_spans(F.col("text"))).select(F.sha2(pii.listed("spans").cast("binary"), 256).alias("h")).first()
    assert row["h"] == hashlib.sha256(b"").hexdigest()
