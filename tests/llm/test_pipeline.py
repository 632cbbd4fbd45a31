"""The pipeline, stage by stage, against brute force on each stage's own input."""

import hashlib
import random

import duckdb
import pytest
from test_decontaminate import plain_score
from test_near_dedup import plain
from test_text_rules import plain_dedup

import __spark_entry__ as entry
import corpus_pipeline
from candlewright.llm import decontaminate, sql
from candlewright.llm.base import saved

WORDS = [a + b for a in ("th", "on", "st", "re", "in", "la") for b in ("er", "ing", "ou", "a", "ent", "ble", "o")]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(6)
    d = str(tmp_path_factory.mktemp("corpus"))
    say = lambda n: " ".join(rng.choice(WORDS) + rng.choice(WORDS) for _ in range(n))
    items = [(i, say(20)) for i in range(5)]
    footer = "this line closes every page of this source"
    rows = [(i, f"{say(40)}\n{say(30)}" + (f"\n{footer}" if i % 3 == 0 else ""), "en", f"s{i % 2}") for i in range(80)]
    rows += [(200 + i, rows[i][1] + " more", "en", "s0") for i in range(10)] + [(300 + i, f"{say(25)} {items[i][1]} {say(25)}", "en", "s1") for i in range(5)]
    rows += [(400, "too short", "en", "s0"), (401, "### $$$ " * 30, "en", "s0"), (402, None, None, None), (403, "", "en", None), (7, rows[7][1], "en", "s1")]
    spark.createDataFrame([(*r, len(r[1] or ""), "x") for r in rows], "doc_id long, text string, lang string, source string, n_chars long, key string").coalesce(2).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    return d


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        before = [(r["doc_id"], r["text"]) for r in docs.collect()]
        docs = saved(stage(spark, docs, folder), name)
        after = docs.collect()
        seen[name] = len(after)
        if name != "sentencepiece":
            assert docs.columns == columns
            ids = sorted(r["doc_id"] for r in after)
        if name == "quality_rules":
            con = duckdb.connect()
            con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet/*.parquet'")
            assert ids == sorted(r[0] for r in con.execute(f"SELECT doc_id FROM ({sql.OP10}) WHERE kept").fetchall())
        elif name == "line_dedup":
            ours = sorted((str(r["doc_id"]), hashlib.sha256(r["text"].encode()).hexdigest()) for r in after)
            assert ours == sorted((d, h) for d, _, _, h in plain_dedup(before)) and all(r["n_chars"] == len(r["text"]) for r in after)
        elif name == "near_dedup":
            keepers = {d for d, _, c in plain(before, 5, 80) if d == c}
            assert {str(i) for i in ids} == keepers
        elif name == "decontamination":
            items = [decontaminate.words_of(r["text"]) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
            clean = [d for d, t in before if all(plain_score(w, decontaminate.words_of(t)) < w.__len__() for w in items)]
            assert ids == sorted(clean)
        else:
            assert all(r["round_trip"] for r in after) and len(after) == 2 * len(before)
    assert list(seen) == ["quality_rules", "line_dedup", "near_dedup", "decontamination", "sentencepiece"]
    assert seen["quality_rules"] < 100 and seen["near_dedup"] < seen["line_dedup"] == seen["quality_rules"] and seen["decontamination"] == seen["near_dedup"] - 5
    assert entry.queries()["pipeline"](spark, folder).count() == seen["sentencepiece"]
