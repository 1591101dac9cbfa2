import duckdb
from tokenizers import Tokenizer as Library

import corpus_pipeline
from brute import components, sha
from forkcast.llm.queries import tokenizer_path
from test_decontam import brute as leaks
from test_secrets import brute as secrets

PATH = "/root/testdata/sf0.01"


def redacted(text):
    out, done = "", 0
    for _, a, b in secrets(text):
        if a >= done:
            out += text[done:a] + "[SECRET]"
        done = max(done, b)
    return out + text[done:]


def test_stages_against_brute_force(spark):
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality", "near_duplicates", "decontamination", "secrets", "tokens"]
    docs = spark.read.parquet(f"{PATH}/documents.parquet")
    text = {r.doc_id: r.text for r in docs.collect()}
    label = dict(duckdb.sql(f"select doc_id, quality from '{PATH}/labels.parquet'").fetchall())
    rows = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, PATH)
        if name != "tokens":
            assert out.dtypes == docs.dtypes
        out = corpus_pipeline.materialize(out, name)
        rows[name] = {r.doc_id: r for r in out.collect()}
        assert out.count() == len(rows[name])
        docs = out
    kept = rows["quality"]
    assert all(kept[i].text == text[i] for i in kept)
    good, bad = ([i for i in label if label[i] == x] for x in (1, 0))
    assert sum(i in kept for i in good) > 0.97 * len(good) and sum(i in kept for i in bad) < 0.3 * len(bad)
    groups = components([(i, r.text) for i, r in kept.items()], 80)
    assert set(rows["near_duplicates"]) == {c for _, c in groups.values()}
    items = [t for t, in duckdb.sql(f"select text from '{PATH}/benchmark.parquet'").fetchall()]
    hit = {i for i, r in rows["near_duplicates"].items() if any(leaks(r.text, t) for t in items)}
    assert hit and set(rows["decontamination"]) == set(rows["near_duplicates"]) - hit
    assert {i: (r.text, r.n_chars) for i, r in rows["secrets"].items()} == {i: (t, len(t)) for i in rows["decontamination"] for t in [redacted(text[i])]}
    library = Library.from_file(tokenizer_path())
    for i, r in rows["tokens"].items():
        ids = library.encode(rows["secrets"][i].text, add_special_tokens=False).ids
        assert list(r.ids) == ids and r.n_tokens == len(ids) and r.decoded_sha256 == sha(library.decode(ids, skip_special_tokens=False))
    whole = {r.doc_id: r.ids_sha256 for r in corpus_pipeline.run(spark, PATH).collect()}
    assert whole == {i: r.ids_sha256 for i, r in rows["tokens"].items()}


def test_odd_rows_through_all_stages(spark):
    rows = [(None, None, None, None, None, "x"), (1, "", "en", "s", 0, None), (1, "", "en", "s", 0, None), (2, "a plain text of some words", None, "", 3, ""),
            (3, "Some words that go on and on. " * 30_000, "en", "s", 900_000, "y"), (3, "Another text under the same number, of a few words.", "en", "s", 1, "y"), (4, "x" * 200_000, "en", "s", 0, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score string")
    for frame in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, frame, PATH)
            assert name == "tokens" or out.dtypes == frame.dtypes
            out.collect()
