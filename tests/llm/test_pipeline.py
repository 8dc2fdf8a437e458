"""The pipeline stage by stage against brute force, and the queries' contracts on the smallest tables."""

import hashlib
import re

import duckdb
import pytest
import tokenizers

import corpus_pipeline
from cellstride.llm import bpe, queries
from cellstride.sources.staging import stage
from test_dedup import brute_components, slow_fingerprint
from test_mixing_sharding import targets

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
NORM = re.compile(r"[\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def stages(spark, small):
    """(name, input rows, output rows) of each stage over documents with some awkward rows added."""
    docs = spark.read.parquet(f"{small}/documents.parquet").select(*[f.split()[0] for f in SCHEMA.split(", ")])
    extra = [(10_000, None, None, None, None), (10_001, "12345 !!", "en", "src1", 8), (10_002, " ", None, "src1", 1),
             (10_003, "Same words  here", "en", None, 3), (10_004, "Same\twords here", "en", "src1", 3), (10_004, "Same\twords here", "en", "src1", 3)]
    docs = stage(docs.unionByName(spark.createDataFrame(extra, SCHEMA)), "test-documents")
    out = []
    for name, step in corpus_pipeline.STAGES:
        done = stage(step(spark, docs, small), "test-stage")
        out.append((name, docs.collect(), done.collect(), docs.columns, done.columns))
        docs = done
    return out


def test_stage_names_and_columns(stages):
    assert [s[0] for s in stages] == ["language ID", "exact dedup", "SimHash near-dedup", "mixing sources to target weights",
                                      "BPE encoding and decoding"]
    assert all(s[3] == s[4] for s in stages[:-1])


def test_language_stage(stages):
    _, before, after, *_ = stages[0]
    gone = {r.doc_id for r in before} - {r.doc_id for r in after}
    assert gone == {10_000, 10_001, 10_002}
    assert len(after) == len([r for r in before if r.doc_id not in gone])


def test_exact_stage(stages):
    _, before, after, *_ = stages[1]
    first = {}
    for r in sorted(before, key=lambda r: r.doc_id):
        first.setdefault(NORM.sub(" ", r.text), r.doc_id)
    assert sorted(r.doc_id for r in after) == sorted(first.values())
    texts = {r.doc_id: r.text for r in before}
    assert all(r.text == texts[r.doc_id] for r in after)


def test_near_stage(stages):
    _, before, after, *_ = stages[2]
    ids = [r.doc_id for r in before]
    components = brute_components(ids, [slow_fingerprint(r.text) for r in before])
    assert sorted(r.doc_id for r in after) == sorted(set(components.values()))


def test_mix_stage(stages):
    _, before, after, *_ = stages[3]
    words = lambda t: len(NORM.sub(" ", t).split())
    sizes, taken, times = {}, {}, {}
    for r in before:
        sizes[r.source] = sizes.get(r.source, 0) + words(r.text)
    for r in after:
        taken[r.source] = taken.get(r.source, 0) + words(r.text)
        times[r.doc_id] = times.get(r.doc_id, 0) + 1
    largest = max(words(r.text) for r in before)
    for s, target in targets(sizes).items():
        assert abs(taken.get(s, 0) - target) <= largest
    assert max(times.values()) <= 3 and set(times) <= {r.doc_id for r in before}


def test_token_stage(stages):
    _, before, after, *_ = stages[4]
    library = tokenizers.Tokenizer.from_file(bpe.default_path())
    expected = []
    for r in before:
        ids = library.encode(r.text, add_special_tokens=False).ids
        digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
        expected.append((r.doc_id, len(ids), digest(",".join(map(str, ids))), digest(library.decode(ids, skip_special_tokens=False))))
    assert sorted((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in after) == sorted(expected)


def test_run(spark, small):
    out = corpus_pipeline.run(spark, small)
    assert out.count() > 0 and {"doc_id", "n_tokens"} <= set(out.columns)


COLUMNS = {
    "op1_mixing": "doc_id size source_size target taken", "op2_simhash": "doc_id fingerprint component_id",
    "op3_vptree": "query_id rank vec_id score", "op4_language": "doc_id held_out lang_pred score",
    "op5_sharding": "doc_id size text_crc32 law shard slot grown_shard", "op6_html": "page_id url text n_chars",
    "op7_bloom_lm": "doc_id held_out n_tokens n_known train_tokens base_score score", "op8_secrets": "doc_id start length score is_secret",
    "op9_bpe": "doc_id n_tokens ids_sha256 decoded_sha256", "op10_exact_dedup": "doc_id keep_id group_size kept text_sha256",
    "op11_quality": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    "op12_whitening": "vec_id component n deviation whitened explained identity_error", "op13_lexical": "item_id rank doc_id score",
}


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_queries(spark, small, name):
    df = queries.QUERIES[name](spark, small)
    assert set(COLUMNS[name].split()) <= set(df.columns)
    n = df.count()
    known = {"op3_vptree": 50, "op6_html": 50, "op12_whitening": 500 * 32, "op13_lexical": None, "op8_secrets": None}.get(name, 200)
    assert n == known if known else n > 0


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_sql(spark, small, name):
    con = duckdb.connect()
    for name_ in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {name_} AS SELECT * FROM '{small}/{name_}.parquet'")
    got = queries.QUERIES[name](spark, small)
    expected = con.execute(queries.ORACLES[name]).df()
    names = sorted(got.columns)
    assert sorted(expected.columns) == names
    assert sorted(map(tuple, got.select(*names).collect())) == sorted(expected[names].itertuples(index=False, name=None))
