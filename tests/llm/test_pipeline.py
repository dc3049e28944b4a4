import random
import re
from pathlib import Path

import corpus_pipeline as cp
from kinfold.llm import near_dedup, pieces, pii, quality_classifier
from tests.llm.test_quality import corpus


def make(spark, path):
    r = random.Random(9)
    rows = [(i, t, "en", "big" if i % 5 else "small", len(t)) for i, t, _ in corpus(400, 3)]
    base = rows[1][1].split()
    rows += [(1000 + k, " ".join([*base, f"extra{k}"]), "en", "big", 9) for k in range(5)]
    rows += [(2000, f"{rows[2][1]} mail me at someone@site.example today", "en", "small", 9), (2001, None, None, None, None), (2000, f"{rows[2][1]} mail me at someone@site.example today", "en", "small", 9)]
    r.shuffle(rows)
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, y, 0) for i, _, y in corpus(400, 3) if i % 2], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return rows


def test_pipeline_against_its_parts(spark, tmp_path):
    rows = make(spark, str(tmp_path))
    out = cp.run(spark, str(tmp_path)).collect()
    assert set(out[0].asDict()) == {"doc_id", "source", "n_tokens", "token_ids"}
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    model = quality_classifier.trained(docs, spark.read.parquet(f"{tmp_path}/labels.parquet").where("quality = 1"))
    text = {r[0]: r[1] for r in rows}
    good = {i for i, t in text.items() if model.score(quality_classifier.features([t]))[0] >= quality_classifier.CUT}
    sets = {i: {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} for i in good if (w := (text[i] or "").lower().split())}
    first = {}
    for i in sorted(sets):
        first[i] = next((first[j] for j in first if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])), i)
    kept = {i for i in sets if first[i] == i}
    assert {r.doc_id for r in out} == kept
    v = pieces.vocabulary(Path(pieces.default_model()).read_bytes())
    for r in out:
        got = pieces.decode(r.token_ids, v)
        want = re.sub(r"\S+@\S+\.example", "[EMAIL]", text[r.doc_id])
        assert got == want and r.n_tokens == len(r.token_ids)
    assert len({i for i in kept if i % 5 == 0 and i < 1000}) <= sum(r.source == "small" for r in out)


def test_stages_take_odd_tables(spark, tmp_path):
    docs = spark.createDataFrame([(1, "a b c d e f", "en", "s", 1, 5), (1, "a b c d e f", "en", "s", 1, 5), (None, None, None, None, None, None)], "doc_id long, text string, lang string, source string, n_chars long, score int")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for table in (docs, docs.where("false")):
        df = table
        for _, stage in cp.STAGES:
            df = stage(spark, df, str(tmp_path))
        df.collect()
    assert near_dedup and pii
