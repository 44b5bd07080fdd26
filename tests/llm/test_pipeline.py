"""The pipeline, and the queries over the smallest tables, against brute force."""

from __future__ import annotations

import html
import random
import re
import zlib
from pathlib import Path

import numpy as np
import pytest

P = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")
corpus_pipeline = pytest.importorskip("corpus_pipeline")

from meridia.llm import queries, secrets  # noqa: E402

from . import test_exact, test_shingles, test_vectors  # noqa: E402

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
here = pytest.mark.skipif(not Path(SF).exists(), reason="no driver tables")


def fixture():
    rng = random.Random(9)
    syllables = {"en": ["the", "ing", "sh", "er", "wh"], "fr": ["éau", "oi", "que", "ch", "lle"]}
    rows = []
    for i in range(120):
        lang = rng.choice(["en", "fr"])
        words = ["".join(rng.choice(syllables[lang]) for _ in range(rng.randint(1, 4))) for _ in range(rng.choice([8, 40, 150]))]
        rows.append([i, " ".join(words), lang, "s", 0])
    for i in range(120, 150):  # exact and near copies, secrets, junk
        base = rng.choice(rows[:100])
        words = base[1].split(" ")
        if i % 3 == 1 and len(words) > 100:
            words[3] = "other"
        if i % 3 == 2:
            words.append(f"token={i:020d}")
        rows.append([i, ("  " if i % 2 else " ").join(words), base[2], "s", 0])
    return [*map(tuple, rows), (500, None, "en", "s", 0), (501, "12 34", "fr", "s", 0)]


def test_stages_against_brute_force(spark, tmp_path):
    rows = fixture()
    spark.createDataFrame(rows, DOCS).write.parquet(str(tmp_path / "documents.parquet"))
    docs, kept = spark.read.parquet(str(tmp_path / "documents.parquet")), {r[0]: r[1] for r in rows}
    steps = dict(corpus_pipeline.STAGES)
    assert list(steps) == ["language_id", "exact_dedup", "minhash_dedup", "secret_scan", "packing"]

    def after(name):
        nonlocal docs
        docs = steps[name](spark, docs, str(tmp_path))
        out = str(tmp_path / name)
        docs.write.parquet(out)
        docs = spark.read.parquet(out)
        if name != "packing":
            assert docs.dtypes == [(c.split()[0], {"long": "bigint"}.get(c.split()[1], c.split()[1])) for c in DOCS.split(", ")]
            return {r.doc_id: r.text for r in docs.collect()}
        return docs.collect()

    got = after("language_id")
    assert got.keys() <= kept.keys() and not {500, 501} & got.keys() and len(got) >= len(kept) - 4
    kept = got
    brute = test_exact.brute(list(kept.items()))
    kept = {i: t for i, t in kept.items() if brute[i][2]}
    assert after("exact_dedup") == kept
    brute = test_shingles.brute(list(kept.items()))
    kept = {i: t for i, t in kept.items() if brute[i][1] == i}
    assert after("minhash_dedup") == kept
    kept = {i: secrets.redact_text(t) for i, t in kept.items()}
    assert after("secret_scan") == kept and not any(secrets.base_spans(t) for t in kept.values())
    pieces = after("packing")
    t = tokenizers.Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    total = {i: len(t.encode(x, add_special_tokens=False).ids) + 1 for i, x in kept.items()}
    found: dict = {}
    for p in pieces:
        found[p.doc_id] = found.get(p.doc_id, 0) + p.length
    assert found == total
    assert sorted(r.ids_crc32 for r in corpus_pipeline.run(spark, str(tmp_path)).collect()) == sorted(p.ids_crc32 for p in pieces)


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], DOCS).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def read(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet").collect()


@here
def test_near_duplicates_of_the_table(spark):
    want = test_shingles.brute([(r.doc_id, r.text) for r in read(spark, "documents")])
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in queries.op5_minhash_dedup(spark, SF).collect()}
    assert got == want


@here
def test_vectors_of_the_table(spark):
    want = test_vectors.brute([(r.vec_id, r.embedding, r.label) for r in read(spark, "embeddings")])
    assert {r.vec_id: (r.n_links, r.component_id) for r in queries.op4_embedding_dedup(spark, SF).collect()} == want


@here
def test_exact_groups_of_the_table(spark):
    want = test_exact.brute([(r.doc_id, r.text) for r in read(spark, "documents")])
    assert {r.doc_id: (r.keep_id, r.group_size, r.kept, r.text_sha256) for r in queries.op6_exact_dedup(spark, SF).collect()} == want


@here
def test_main_text_of_the_pages(spark):
    def article(page):
        body = re.search(r"<article>(.*?)(</article>|$)", page, re.S)[1]
        parts = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)[^>]*>", body)]
        return "\n\n".join(x for x in parts if x)

    want = {r.page_id: article(r.html) for r in read(spark, "pages")}
    assert {r.page_id: r.text for r in queries.op8_html_text(spark, SF).collect()} == want


@here
def test_packing_of_the_table(spark):
    t = tokenizers.Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    ids = {r.doc_id: np.array([*t.encode(r.text or "", add_special_tokens=False).ids, 0], "<u4") for r in read(spark, "documents")}
    seen = dict.fromkeys(ids, 0)
    for r in queries.op10_packing(spark, SF).collect():
        part = ids[r.doc_id][r.start : r.start + r.length]
        assert zlib.crc32(part.tobytes()) == r.ids_crc32 and r.offset + r.length <= 1024
        seen[r.doc_id] += r.length
    assert seen == {i: len(x) for i, x in ids.items()}


@here
def test_secrets_and_pages_of_the_tables(spark):
    docs = {r.doc_id: r.text or "" for r in read(spark, "documents")}
    for r in queries.op2_secret_scan(spark, SF).collect():
        base = secrets.base_spans(docs[r.doc_id])
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == i for _, k, _ in base) for i in range(3))
    pages = {r.page_id: r.html for r in read(spark, "pages")}
    got = queries.op3_warc(spark, SF).collect()
    assert {r.page_id: r.payload_bytes for r in got} == {i: len(h.encode()) for i, h in pages.items()}


@here
def test_languages_of_the_table(spark):
    truth = {r.doc_id: r.lang for r in read(spark, "documents")}
    held = [r for r in queries.op7_language_id(spark, SF).collect() if r.held_out]
    assert np.mean([truth[r.doc_id] == r.lang_pred for r in held]) > 0.95


@here
def test_repeated_passages_of_the_table(spark):
    docs = {r.doc_id: (r.text or "").split() for r in read(spark, "documents")}
    seen: dict = {}
    for i, w in docs.items():
        for j in range(len(w) - 51):
            seen.setdefault(tuple(w[j : j + 52]), set()).add(i)
    want = {i for v in seen.values() if len(v) > 1 for i in v}
    assert want <= {r.doc_id for r in queries.op9_substring_dedup(spark, SF).collect()}
