"""The stages one by one, and the pipeline as a whole."""

import random
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

import corpus_pipeline
from tallymark.llm.common import WORDS, written
from tallymark.llm.common import documents as table
from tallymark.llm.line_chunks import LINE_DEDUP_SQL
from tallymark.llm.mixing import MIXING_SQL
from tallymark.llm.quality_classifier import classify
from tests.llm.helpers import CLASH, EDGES, documents
from tests.llm.test_duplicates import brute_jaccard

SF_DIR = "/root/testdata/sf0.001"


def test_stages_keep_the_columns_and_shrink_what_they_filter(spark):
    docs = table(spark, SF_DIR)
    columns, rows = docs.columns, docs.count()
    names = [n for n, _ in corpus_pipeline.STAGES]
    for name, stage in corpus_pipeline.STAGES[:3]:
        docs = written(stage(spark, docs, SF_DIR), name)
        assert docs.columns == columns and docs.count() <= rows
        rows = docs.count()
    words = sum(len(r.text.split()) for r in docs.collect())
    mixed = written(corpus_pipeline.STAGES[3][1](spark, docs, SF_DIR), "mixed")
    taken = sum(len(r.text.split()) for r in mixed.collect())
    assert mixed.columns == columns and abs(taken - 1.5 * words) < 0.01 * words
    packed = corpus_pipeline.STAGES[4][1](spark, mixed, SF_DIR)
    assert packed.select("doc_id").distinct().count() == mixed.select("doc_id").distinct().count()
    assert len(names) == 5
    assert corpus_pipeline.run(spark, SF_DIR).count() == packed.count()


def test_one_document_is_left_of_each_group_of_exact_copies(spark):
    rng = random.Random(6)
    line = lambda: " ".join(f"w{rng.randrange(10_000)}" for _ in range(rng.randrange(1, 90)))
    texts = ["\n".join(line() for _ in range(rng.randrange(2, 12))) for _ in range(30)]
    docs = documents(spark, [(100 * k + t, text, "a") for k in range(3) for t, text in enumerate(texts)])
    for name, stage in corpus_pipeline.STAGES[1:3]:
        docs = written(stage(spark, docs, SF_DIR), name)
    assert sorted((r.doc_id, r.text) for r in docs.collect()) == list(enumerate(texts))


def test_stages_on_edge_rows_and_empty_tables(spark):
    for docs in (documents(spark, EDGES), documents(spark, [])):
        for name, stage in corpus_pipeline.STAGES:
            found = stage(spark, docs, SF_DIR)
            if name != "best_fit_packing":
                assert found.schema.simpleString() == docs.schema.simpleString()
                own = found.select("key", "score", "size", "n_removed", "component_id", "row").distinct().collect()
                assert {tuple(r) for r in own} <= {CLASH}
            assert (found.count() > 0) == (docs.count() > 0)


def by_sql(sql, ids, texts, sources):
    connection = duckdb.connect()
    connection.register("documents", pa.table({"doc_id": ids, "text": pa.array(texts, pa.string()), "source": sources}))
    result = connection.execute(sql)
    names = [d[0] for d in result.description]
    return {r["doc_id"]: r for r in (dict(zip(names, row)) for row in result.fetchall())}


def test_run_agrees_with_plain_forms_of_its_stages(spark):
    """All rows of the last stage: SQL for the lines and the mix, all pairs, the tokenizer's library."""
    sf_dir = "/root/testdata/sf0.01"
    docs = table(spark, sf_dir)
    good = classify(spark, docs, spark.read.parquet(f"{sf_dir}/labels.parquet")).where("predicted = 1").collect()
    source = {r.doc_id: r.source for r in good}
    columns = lambda texts: (list(texts), list(texts.values()), [source[i] for i in texts])
    lines = by_sql(LINE_DEDUP_SQL, *columns({r.doc_id: r.text for r in good}))
    texts = {i: r["text"] for i, r in sorted(lines.items()) if not r["n_removed"] or r["text"]}
    assert len(source) > len(texts) > 0
    first = brute_jaccard(list(texts.values()), 80)[1]
    texts = {i: t for n, (i, t) in enumerate(texts.items()) if first[n] == n}
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = Counter()
    for i, r in by_sql(MIXING_SQL, *columns(texts)).items():
        if not r["taken"]:
            continue
        whole, rest = divmod(r["taken"], r["size"])
        parts = [" ".join(WORDS.findall(texts[i])[:rest])] if rest else []
        for text in [texts[i]] * whole + parts:
            ids = np.array([*library.encode(text, add_special_tokens=False).ids, 2], "<u4")
            cuts = [0, *range(len(ids) % 1024 or 1024, len(ids) + 1, 1024)]
            want.update((i, p, a, b - a, zlib.crc32(ids[a:b].tobytes())) for p, (a, b) in enumerate(zip(cuts, cuts[1:])))
    got = corpus_pipeline.run(spark, sf_dir).collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for pieces in sequences.values():
        ends = np.cumsum([n for _, n in sorted(pieces)]).tolist()
        assert [at for at, _ in sorted(pieces)] == [0, *ends[:-1]] and ends[-1] <= 1024
    assert len(sequences) <= 1.02 * -(-sum(r.length for r in got) // 1024)
