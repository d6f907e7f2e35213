"""Ranked search, packing and phrase mining against plain versions."""

import math
import random
import re
import zlib
from array import array
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from edge_texts import EDGES
from moontally.llm import cost_packing, hat_trie, phrase_mining, queries, sketch_search

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
MODEL = public_tokenizers.path("word_bpe_49k.json")


# Ranked search


def ranked(docs, items, top=20):
    """docs: (id, text), items: (id, text). Rows (item, rank, id, score) by the definition, exact for documents of any ids."""
    bags = [(i, Counter(TERM.findall((text or "").translate(LOWER)))) for i, text in docs]
    bags = [(i, bag) for i, bag in bags if bag]
    total = sum(sum(bag.values()) for _, bag in bags)
    holding = Counter(term for _, bag in bags for term in bag)
    out = []
    for item, text in items:
        scores = []
        for i, bag in bags:
            m = 75 + (25 * sum(bag.values()) * len(bags)) // total
            score = 0
            for term, times in Counter(TERM.findall((text or "").translate(LOWER))).items():
                if term in bag:
                    w = math.floor(1000 * math.log((2 * len(bags) + 2) / (2 * holding[term] + 1)))
                    score += times * w * ((1_000_000_000 * bag[term]) // (1000 * bag[term] + 12 * m))
            if score > 0:
                scores.append((-score, i is None, i))
        out += [(item, rank + 1, i, -score) for rank, (score, _, i) in enumerate(sorted(scores, key=lambda x: (x[0], x[1], x[2] or 0))[:top])]
    return sorted(out, key=repr)


def searched(docs, items, **more):
    rows = sketch_search.search(docs, "doc_id", "text", items, "item_id", "text", **more)
    assert rows.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    return sorted((tuple(r) for r in rows.collect()), key=repr)


@pytest.mark.parametrize("more", [{}, {"width": 4}, {"batch_terms": 40}, {"top": 3, "width": 64}])
def test_search_equals_plain_scores(spark, sf_dir, more):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").repartition(5)
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").limit(8)
    wanted = ranked([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()], more.get("top", 20))
    assert searched(docs, items, **more) == wanted


def test_search_of_edge_texts(spark, edges, none):
    items = [(1, "one line two"), (2, None), (3, "!!"), (4, "same SAME here"), (4, "É🙂 é🙂"), (5, "of a"), (None, "null id")]
    frame = spark.createDataFrame([(*x, "clash") for x in items], "item_id long, text string, doc_id string")
    docs = [(r.doc_id, r.text) for r in edges.collect()]
    assert searched(edges, frame) == ranked(docs, items)
    assert searched(none, frame) == [] and searched(edges, frame.where("item_id = 99")) == []


def test_search_scores_few_documents_exactly(spark, sf_dir):
    docs = [r.text or "" for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    item = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet").first().text
    hashes, cuts = sketch_search.terms(pa.array(docs))
    batch = sketch_search.Queries([0], [sketch_search.terms(pa.array([item]))[0]])
    owner, own, tf = sketch_search.counted(hashes, cuts)
    hit, at = batch.found(own)
    batch.weigh(len(docs), len(hashes), np.bincount(at, minlength=len(batch.vocabulary)))
    search = sketch_search.Search(batch, 20, sketch_search.WIDTH)
    lengths = np.diff(cuts)
    for a in range(0, len(docs), 100):
        some = (owner >= a) & (owner < a + 100)
        search.block(np.arange(a, a + 100), np.zeros(100, bool), lengths[a : a + 100], owner[some] - a, own[some], tf[some])
    assert search.scored < len(docs) / 2


# Packing


def test_packing_of_a_table(spark, sf_dir):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = queries.op12_cost_packing(spark, sf_dir).collect()
    check_packing(rows, docs)


def check_packing(rows, docs, capacity=4096, crc=lambda r: r.ids_crc32):
    tokenizer = Tokenizer.from_file(MODEL)
    ids = {i: tokenizer.encode(text or "", add_special_tokens=False).ids + [2] for i, text in docs.items()}
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    assert set(by_doc) == set(ids)
    for i, pieces in by_doc.items():
        at = 0
        for r in sorted(pieces, key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids[i])) and r.length > 0
            assert crc(r) == zlib.crc32(array("I", ids[i][at : at + r.length]).tobytes())
            at += r.length
        assert at == len(ids[i])
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity and at & (at - 1) == 0  # a power of two: not padded
    return by_sequence


@pytest.mark.parametrize("capacity, pool", [(4096, 1 << 22), (64, 300), (1, 10)])
def test_packing_of_edge_texts(spark, edges, none, capacity, pool):
    docs = edges.where("doc_id is not null").dropDuplicates(["doc_id"])
    rows = cost_packing.pack(docs, "doc_id", "text", MODEL, 2, capacity, pool).collect()
    check_packing(rows, dict(enumerate(EDGES)), capacity, crc=lambda r: zlib.crc32(r.ids))
    repeated = cost_packing.pack(edges, "doc_id", "text", MODEL, 2).where("start = 0")
    assert repeated.count() == edges.count() and repeated.where("doc_id is null").count() == 1
    assert cost_packing.pack(none, "doc_id", "text", MODEL, 2).count() == 0
    with pytest.raises(ValueError):
        cost_packing.pack(edges, "doc_id", "text", MODEL, 2, capacity=48)


def first_fit(lengths, capacity):
    """Costs of the sequences if descending documents go to the first with room."""
    left = cost_packing.rooms(sum(lengths), capacity)
    costs, waiting = [0.0] * len(left), sorted(lengths)
    while waiting:
        n = waiting.pop()
        to = next((k for k, room in enumerate(left) if room >= n), None)
        if to is None:
            to = next(k for k, room in enumerate(left) if room)
            waiting = sorted([*waiting, n - left[to]])
            n = left[to]
        left[to] -= n
        costs[to] += cost_packing.cost(n)
    return costs


def test_packing_balances_costs():
    rng = random.Random(3)
    lengths = [min(2500, int(rng.lognormvariate(5.5, 1.2)) + 1) for _ in range(4000)]
    pieces = list(cost_packing.place(lengths, 4096))
    costs = defaultdict(float)
    for _, _, n, to, _ in pieces:
        costs[to] += cost_packing.cost(n)
    full = sum(lengths) // 4096
    assert np.std([costs[i] for i in range(full)]) < 0.75 * np.std(first_fit(lengths, 4096)[:full])
    cut = Counter(i for i, *_ in pieces)
    assert sum(n == 1 for n in cut.values()) > 0.95 * len(lengths)


TOKENIZER = Tokenizer.from_file(MODEL)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab IT'sS.,;́éÅ \t\n\x0b\x1c  Σﬁ\U0001f64212<|endoftext>")) | st.text(), max_size=4))
def test_ids_are_those_of_the_library(texts):
    table = cost_packing.Table(TOKENIZER, most=8)
    ids, cuts = table.encode(pa.array([*texts, None, "the end."], pa.string()))
    for text, a, b in zip([*texts, "", "the end."], cuts, cuts[1:]):
        assert ids[a:b].tolist() == TOKENIZER.encode(text, add_special_tokens=False).ids


# Phrases


@pytest.mark.parametrize("seed", range(12))
def test_trie_counts_and_runs_are_in_order(seed):
    rng = np.random.default_rng(seed)
    width = int(rng.integers(1, 5))
    trie = hat_trie.HatTrie(width, burst=int(rng.integers(4, 64)), most=int(rng.integers(50, 3000)), depth=int(rng.integers(1, 4)))
    wanted, got = Counter(), Counter()

    def take(runs):
        for rows, counts in runs:
            rows = [tuple(x) for x in rows.tolist()]
            assert rows == sorted(set(rows))
            got.update(dict(zip(rows, counts.tolist())))

    few = np.array([3, 2**64 - 1, 0, 77], dtype=np.uint64)
    for _ in range(30):
        rows = few[rng.choice(4, size=(int(rng.integers(0, 200)), width), p=[0.7, 0.1, 0.1, 0.1])]
        mixed = rng.random(rows.shape) < 0.3
        rows[mixed] = rng.integers(0, 2**63, size=mixed.sum(), dtype=np.uint64)
        wanted.update(map(tuple, rows.tolist()))
        take(trie.add(rows))
        assert trie.root.size <= trie.most
    take(trie.finish())
    assert got == wanted


def mined(rows, least, first):
    """Phrases of (text, lang) by the definition, counted in memory."""
    counts, total = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(LOWER)):
            words = re.findall("[^\x20\x09]+", piece)
            total[lang] += len(words)
            for k in range(1, 5):
                counts[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, own in counts.items():
        candidates = {x: n for x, n in own.items() if len(x) > 1 and n >= least}
        most = Counter()
        for x, n in candidates.items():
            for k in range(2, len(x)):
                for i in range(len(x) - k + 1):
                    most[x[i : i + k]] = max(most[x[i : i + k]], n)
        found = []
        for x, a in candidates.items():
            if 100 * most[x] >= 80 * a:
                continue
            score, _, left, right = min((2_000_000 * a // (own[x[:k]] + own[x[k:]]), k, own[x[:k]], own[x[k:]]) for k in range(1, len(x)))
            found.append((-score, -a, " ".join(x).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:first]):
            out.append((lang, rank + 1, phrase.decode(), -a, left, right, total[lang], -score))
    return sorted(out)


def phrase_rows(docs, least, first):
    return sorted(map(tuple, phrase_mining.phrases(docs, "text", "lang", least, first).collect()))


def test_phrases_equal_plain_counts(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").repartition(4)
    wanted = mined([(r.text, r.lang) for r in docs.collect()], 5, 40)
    assert phrase_rows(docs, 5, 40) == wanted and len(wanted) > 100


def test_phrases_of_edge_texts(spark, edges, none):
    texts = ["New York, new york new\tYORK", "new york.city new york city hall", "É É é É É", "a a a a a a", "x y\nx y\rx y\x0bx y", "z z\x00 z z\x00", None, ""]
    rows = [(text, lang, "clash") for text in texts for lang in ("en", None, "und", "")]
    made = spark.createDataFrame(rows, "text string, lang string, n string")
    assert phrase_rows(made, 3, 10) == mined([r[:2] for r in rows], 3, 10)
    assert phrase_rows(edges, 2, 50) == mined([(r.text, r.lang) for r in edges.collect()], 2, 50)
    assert phrase_rows(none, 1, 5) == []
