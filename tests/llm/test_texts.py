"""Operators that look at one text at a time: classifier, pieces, rules."""

import hashlib
import math
import re
import zlib
from array import array
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece

from edge_texts import EDGES
from moontally.llm import piece_encoding, quality_classifier, quality_rules, queries, textkernel

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def documents(spark, folder):
    return {r.doc_id: r for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}


def test_words_and_hashes_of_the_kernel():
    texts = [*EDGES, "a\x0bb\x0cc", "tail "]
    data, starts, ends, cuts = textkernel.words(pa.array(texts))
    hashes = textkernel.hashes(data, starts, ends)
    seen = {}
    for i, text in enumerate(texts):
        found = [bytes(data[a:b]).decode() for a, b in zip(starts[cuts[i] : cuts[i + 1]], ends[cuts[i] : cuts[i + 1]])]
        assert found == WORD.findall(text or "")
        for word, value in zip(found, hashes[cuts[i] : cuts[i + 1]]):
            assert seen.setdefault(word, value) == value
    assert len(set(seen.values())) == len(seen)
    empty = textkernel.words(pa.array([], pa.string()))
    assert len(empty[1]) == 0 and empty[3].tolist() == [0]


def test_classifier_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = queries.op1_quality_classifier(spark, folder).collect()
    assert len(rows) == 1000
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)
    held = [(labels[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in labels]
    assert len(held) > 50 and sum(a == b for a, b in held) / len(held) >= 0.95


def test_classifier_scores_are_sparse_dot_products(spark, edges, none):
    bits = 10
    weights = np.random.default_rng(1).normal(size=2**bits + 1).astype(np.float32)
    rows = quality_classifier.score(edges, "doc_id", "text", weights).collect()
    assert len(rows) == edges.count()
    for r in rows:
        text = EDGES[r.doc_id] if r.doc_id is not None else "a null id"
        places, _ = quality_classifier.features(pa.array([text], pa.string()), bits)
        counts = Counter(places.tolist())
        dot = sum(float(weights[p]) * n for p, n in counts.items()) * quality_classifier.SCALE / max(len(places), 1)
        assert r.score == pytest.approx(1 / (1 + math.exp(-max(-40, min(40, dot + float(weights[-1]))))), abs=1e-9)
    assert quality_classifier.score(none, "doc_id", "text", weights).count() == 0
    kept = quality_classifier.accept(edges, "text", weights, 0.5)
    assert kept.columns == edges.columns and kept.count() == sum(r.score >= 0.5 for r in rows)


def test_classifier_without_labels_is_undecided(spark, none):
    weights = quality_classifier.train(none.selectExpr("text", "1 AS label", "doc_id"), "text", "label", "doc_id")
    assert len(weights) == 2**18 + 1 and not weights.any()


@pytest.fixture(scope="module")
def processor():
    return sentencepiece.SentencePieceProcessor(model_file=queries.model_path())


def test_pieces_equal_the_library_on_all_documents(spark, sf_dir, processor):
    texts = documents(spark, sf_dir)
    rows = queries.op3_piece_encoding(spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = processor.encode(texts[r.doc_id].text or "", add_bos=True, add_eos=True)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(array("I", ids).tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(processor.decode(ids).encode()).hexdigest()


def test_pieces_of_edge_texts(spark, edges, none, processor):
    rows = piece_encoding.encode(edges, "doc_id", "text", queries.model_path()).collect()
    assert len(rows) == edges.count()
    for r in rows:
        text = (EDGES[r.doc_id] if r.doc_id is not None else "a null id") or ""
        ids = processor.encode(text, add_bos=True, add_eos=True)
        assert list(array("I", r.ids)) == ids and r.decoded == processor.decode(ids)
    assert piece_encoding.encode(none, "doc_id", "text", queries.model_path()).count() == 0


def test_a_full_table_of_words_starts_anew(processor):
    table = piece_encoding.Table(processor, most=50)
    rng = np.random.default_rng(2)
    for _ in range(30):
        texts = ["".join(rng.choice(["a", "b", " ", "  ", "é", "▁", "\n", "zz"], 20)) for _ in range(5)]
        for text, (ids, back) in zip(texts, table.encode(texts)):
            assert list(array("I", ids)) == processor.encode(text) and back.decode() == processor.decode(processor.encode(text))
        assert len(table.ids) <= 200


def brute_rules(text):
    words = WORD.findall(text or "")
    grams = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    covered = {i + k for i in range(len(words) - 4) if grams[tuple(words[i : i + 5])] > 1 for k in range(5)}
    lines, seen, repeats = (text or "").split("\n"), set(), 0
    for line in lines:
        if WORD.search(line):
            repeats += line in seen
            seen.add(line)
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), repeats, len(covered), failed


def test_base_rules_equal_counts_one_by_one(spark, sf_dir, edges, none):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    reference = quality_rules.references(docs, "text", "lang").collect()
    texts = {k: v.text for k, v in documents(spark, sf_dir).items()}
    rows = queries.op7_quality_rules(spark, sf_dir).collect()
    assert len(rows) == len(texts)
    frame = spark.createDataFrame(reference, "lang string, kind int, key long, n long")
    own = quality_rules.rules(edges, "doc_id", "text", frame).collect()
    assert len(own) == edges.count()
    pairs = [(r, texts[r.doc_id]) for r in rows]
    pairs += [(r, EDGES[r.doc_id] if r.doc_id is not None else "a null id") for r in own]
    for r, text in pairs:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute_rules(text)
        assert not (r.base_failed and r.kept)
    assert quality_rules.rules(none, "doc_id", "text", frame).count() == 0


def test_references_count_all_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = quality_rules.references(docs, "text", "lang", least=1).collect()
    for lang in ("de", "en", "es", "fr"):
        words = Counter()
        for r in docs.where(docs.lang == lang).collect():
            words.update(w.encode().lower() for w in WORD.findall(r.text or ""))
        assert [r.n for r in rows if r.lang == lang and r.kind == 2] == [sum(words.values())]
        common = sorted((r.n for r in rows if r.lang == lang and r.kind == 1), reverse=True)
        assert common == sorted(words.values(), reverse=True)[: quality_rules.COMMON_WORDS]


def test_distance_by_definition():
    p, q = np.array([[3.0, 1.0, 0.0], [0.0, 0.0, 0.0], [2.0, 2.0, 4.0]]), np.array([1.0, 1.0, 2.0])
    got = quality_rules.distance(p, q)

    def entropy(x):
        return -sum(v * math.log2(v) for v in x if v)

    a, b = p[0] / 4, q / 4
    assert got[0] == pytest.approx(math.sqrt(entropy((a + b) / 2) - (entropy(a) + entropy(b)) / 2))
    assert got[1] == 0 and got[2] == pytest.approx(0, abs=1e-7)


def test_a_fifth_language_has_its_own_reference(spark):
    """Clean texts of a language that no other resembles stay; junk fails whether or not its language has a reference."""
    rng = np.random.default_rng(5)
    common = ["ja", "on", "ei", "se", "että", "niin", "kun", "mutta", "oli", "hän"]
    rare = ["".join(rng.choice(list("aeioäyklmnprstv"), size=rng.integers(3, 9))) for _ in range(3000)]
    clean = [" ".join(str(rng.choice(common if rng.random() < 0.5 else rare)) for _ in range(200)) for _ in range(60)]
    junk = [" ".join("".join(rng.choice(list("0123456789#$%&=+"), size=8)) for _ in range(200)) for _ in range(5)]
    rows = [(i, x, "fi") for i, x in enumerate(clean)] + [(100 + i, x, ("fi", "zz", None, "fi", "zz")[i]) for i, x in enumerate(junk)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    reference = quality_rules.references(docs, "text", "lang")
    assert {r.lang for r in reference.collect()} == {"fi"}
    kept = {r.doc_id for r in quality_rules.rules(docs, "doc_id", "text", reference).where("kept").collect()}
    assert kept == set(range(60))


def test_scores_do_not_depend_on_neighbours(spark):
    weights = np.random.default_rng(2).normal(size=2**10 + 1).astype(np.float32)
    texts = [f"word{i} " * (i % 7) + "end" for i in range(300)]
    scores = quality_classifier.scorer(spark, weights)
    assert [scores(pa.array([x]))[0] for x in texts] == scores(pa.array(texts)).tolist()


def test_junk_fails_and_clean_texts_stay(spark):
    folder = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = [r for r in queries.op7_quality_rules(spark, folder).collect() if r.doc_id in labels and not r.base_failed]
    clean = [r.kept for r in rows if labels[r.doc_id] == 1]
    junk = [r.kept for r in rows if labels[r.doc_id] == 0]
    assert all(clean) and sum(junk) <= 0.2 * len(junk)
