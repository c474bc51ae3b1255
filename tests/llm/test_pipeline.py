"""The corpus pipeline: each stage against brute force on its own input, and the registered queries."""

import sys
from collections import Counter

import duckdb
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as E
import corpus_pipeline as P
from tests.llm import brute
from tests.llm.helpers import SF, docs
from tests.llm.test_quality import slow_probability
from tests.llm.test_simhash import brute_components, brute_fp
from weir.llm import bpe, oracle, quality, queries
from weir.llm.text import table

sys.path.insert(0, "scripts")


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """Each stage's input and output, written and read again."""
    out, df = {}, table(spark, SF, "documents")
    for name, stage in P.STAGES:
        got = stage(spark, df, SF)
        path = str(tmp_path_factory.mktemp("stage") / "t")
        got.write.parquet(path)
        got = spark.read.parquet(path)
        out[name] = (df.collect(), got.collect(), got.columns)
        df = got
    return out


def test_stages_in_order():
    assert [n for n, _ in P.STAGES] == ["quality rules", "line dedup", "simhash near-dedup", "source mixing", "bpe encoding"]
    assert P.ORACLE_SQL is None


def test_all_but_the_last_keep_the_columns(spark, stages):
    want = table(spark, SF, "documents").columns
    assert all(stages[n][2] == want for n, _ in P.STAGES[:-1])


def test_quality_stage(spark, stages):
    src, got, _ = stages["quality rules"]
    model = quality.train(table(spark, SF, "documents"), table(spark, SF, "labels"))
    want = [r for r in src if not brute.base_quality(r.text)[5]
            and (model is None or slow_probability(model, r.text) >= quality.THRESHOLD)]
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))
    assert 0 < len(got) < len(src)


def test_line_stage(stages):
    src, got, _ = stages["line dedup"]
    text = {r.doc_id: r for r in got}
    assert len(got) == len(src)
    for i, _, _, kept in brute.line_dedup([(r.doc_id, r.text) for r in src]):
        assert text[i].text == kept and text[i].n_chars == len(kept)


def test_simhash_stage(stages):
    src, got, _ = stages["simhash near-dedup"]
    groups = brute_components([(r.doc_id, brute_fp(r.text)) for r in src])
    assert sorted(map(tuple, got)) == sorted(tuple(r) for r in src if groups[r.doc_id] == r.doc_id)
    assert len(got) < len(src)


def test_mixing_stage(stages):
    src, got, _ = stages["source mixing"]
    copies = brute.mix_copies([(r.doc_id, r.text, r.source) for r in src])
    assert Counter(map(tuple, got)) == Counter({tuple(r): c for r, (*_, c) in zip(src, copies) if c})


def test_bpe_stage(stages):
    src, got, cols = stages["bpe encoding"]
    lib = Tokenizer.from_file(bpe.default_path())
    ids = Counter((r.doc_id, tuple(lib.encode(r.text or "", add_special_tokens=False).ids)) for r in src)
    assert Counter((r.doc_id, tuple(r.tokens)) for r in got) == ids
    assert all(r.n_tokens == len(r.tokens) for r in got) and "tokens" in cols


def test_run_gives_the_last_stage(spark, stages):
    got = P.run(spark, SF).collect()
    assert Counter((r.doc_id, tuple(r.tokens)) for r in got) == Counter((r.doc_id, tuple(r.tokens)) for r in stages["bpe encoding"][1])


def test_stages_take_awkward_rows(spark, tmp_path):
    t = "plain words in a line of this text\nand another line of words here\nthird line with more words to see\n"
    df = docs(spark, [None, "", t, t, t + "one more", "x " * 30000], ids=[1, 2, 3, 3, None, 5], sources=[None, "a", "a", "a", "b", None])
    for empty in (False, True):
        d = df.where("doc_id = -9") if empty else df
        for name, stage in P.STAGES:
            out = str(tmp_path / f"{empty}-{name.replace(' ', '-')}")
            stage(spark, d, SF).write.parquet(out)
            d = spark.read.parquet(out)
        assert d.columns == ["doc_id", "lang", "source", "n_tokens", "tokens"]


def test_queries_are_registered():
    names = list(queries.queries())
    assert [int(n[2:].split("_")[0]) for n in names] == list(range(1, 14))
    found = E.queries()
    assert set(names) <= set(found) and found["pipeline"] is P.run
    assert set(oracle.oracle_sql()) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(oracle.oracle_sql()))
def test_query_matches_sql(spark, name):
    from check_oracle import digest

    con = duckdb.connect()
    for t in ("documents", "conversations", "embeddings", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = queries.queries()[name](spark, SF)
    cur = con.execute(oracle.oracle_sql()[name])
    cols = [d[0] for d in cur.description]
    assert sorted(cols) == sorted(df.columns)
    assert digest(df.columns, [tuple(r) for r in df.collect()])[0] == digest(cols, cur.fetchall())[0]
