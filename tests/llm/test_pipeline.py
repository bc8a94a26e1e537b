"""The pipeline against its stages run plainly one after the other, and what its queries return."""

import collections
import random

import duckdb
import pytest
import sentencepiece

import corpus_pipeline
from quillgraph.llm import queries, subwords

from .test_operators import SCHEMA, brute_repeats, texts

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_same_rows_as_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    got, want = queries.QUERIES[name](spark, SF), con.execute(queries.ORACLE[name])
    assert sorted(got.columns) == sorted(d[0] for d in want.description)
    rows = con.execute(f"SELECT {', '.join(got.columns)} FROM ({queries.ORACLE[name]})").fetchall()
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, rows))


def test_stages(spark, tmp_path):
    rows = [(i, t, "en", "ab"[i % 2], len(t or ""), 1, "k", 2, 3) for i, t in enumerate(texts(9, 25))]
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, 1, 0) for i in range(9)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs, kept = spark.read.parquet(str(tmp_path / "documents.parquet")), []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, str(tmp_path))
        assert k == len(corpus_pipeline.STAGES) - 1 or out.schema.names == docs.schema.names
        out.write.parquet(str(tmp_path / f"s{k}"))
        docs = spark.read.parquet(str(tmp_path / f"s{k}"))
        kept.append(docs.collect())
    assert len(kept[0]) == len(rows)  # nothing toxic
    assert len(kept[1]) < len(rows)
    removed = {i: n for i, _, n, _, _ in brute_repeats([(r.doc_id, r.text) for r in kept[1]], 200)}
    before = {r.doc_id: r.text for r in kept[1]}
    assert {r.doc_id for r in kept[2]} == set(before)
    for r in kept[2]:
        assert len((before[r.doc_id] or "").encode()) - len((r.text or "").encode()) - removed[r.doc_id] in (0, 1, 2, 3)  # a broken character goes too
    sp = sentencepiece.SentencePieceProcessor(model_file=subwords.MODEL)
    assert sorted(r.ids for r in kept[4]) == sorted(sp.encode([r.text or "" for r in kept[3]]))
    whole = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted((r.doc_id, r.ids) for r in whole) == sorted((r.doc_id, r.ids) for r in kept[4])


def test_stages_on_toxic_and_repeated_rows(spark, tmp_path):
    """Toxic documents go and clean ones stay; rows that repeat an id, or have none, are documents of their own; null, empty and long texts pass."""
    r = random.Random(21)
    word = lambda: "".join(r.choice("aeiourstln") for _ in range(5))
    clean, bad = [word() for _ in range(500)], ["idiot", "moron", "scum"]
    rows, labels = [], []
    for i in range(600):
        w = [r.choice(clean) for _ in range(r.randint(20, 80))]
        if i % 4 == 0:
            for _ in range(4):
                w[r.randrange(len(w))] = r.choice(bad)
        rows.append((i, " ".join(w)))
        if i % 2 == 0:
            labels.append((i, 1, int(i % 4 == 0)))
    kept_texts = [t for i, t in rows if i % 4]
    odd = [(None, None), (None, ""), (1, "another text under a used id " + word()), (None, kept_texts[0]), (5000, " ".join(word() for _ in range(20_000)))]
    table = [(i, t, "en", "ab"[k % 2], len(t or ""), 1, "k", 2, 3) for k, (i, t) in enumerate([*rows, rows[3], *odd])]
    spark.createDataFrame(table, SCHEMA).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    passed = corpus_pipeline.clean(spark, docs, str(tmp_path))
    left = [x.text for x in passed.collect()]
    toxic = {t for i, t in rows if i % 4 == 0}
    assert len([t for t in left if t in toxic]) <= 0.03 * len(toxic)
    assert len([t for t in left if t in set(kept_texts)]) >= 0.97 * len(kept_texts)
    one = corpus_pipeline.distinct(spark, passed, str(tmp_path)).collect()
    counts = collections.Counter(x.text for x in one)
    assert counts[rows[3][1]] == 1 and counts[kept_texts[0]] == 1 and counts[None] == 1 and counts[odd[2][1]] == 1 and counts[odd[4][1]] == 1
    result = corpus_pipeline.run(spark, str(tmp_path)).collect()
    sp = sentencepiece.SentencePieceProcessor(model_file=subwords.MODEL)
    assert not {sp.decode(x.ids) for x in result} & toxic - set(left)


def test_no_documents(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
