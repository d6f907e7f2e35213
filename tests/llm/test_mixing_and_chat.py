"""Poisson mixing, quotation linking, the pipeline, and the SQL of queries."""

import hashlib
import math
from collections import Counter

import duckdb
import pytest

import corpus_pipeline
from check import compare, database
from moontally.llm import personal_data, queries, quotation_threads, source_mixing
from moontally.llm.oracle import ORACLE


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, sf_dir, name):
    verdict = compare(spark, database(sf_dir), sf_dir, name)
    assert verdict.startswith("ok") and "types" not in verdict, verdict


def draws(rate: float, doc_id) -> int:
    name = "null" if doc_id is None else doc_id
    u = int(hashlib.md5(f"17:{name}".encode()).hexdigest()[:13], 16) / 2**52
    k, p = 0, math.exp(-rate)
    total = p
    while total <= u:
        k += 1
        p *= rate / k
        total += p
    return k


def test_copies_invert_the_distribution(spark):
    rows = [(i, "hot" if i % 3 == 0 else f"s{i % 5}", "x", i) for i in range(900)] + [(7, None, "x", 7), (None, None, "x", 7), (5, "s0", "x", 5)]
    frame = spark.createDataFrame(rows, "doc_id long, source string, copy string, _at long")
    got = source_mixing.mix(frame, "doc_id", "source")
    assert got.columns == ["doc_id", "source", "copy", "_at", "copy_"]
    sizes = Counter(r[1] for r in rows)
    whole = sum(math.sqrt(n / len(rows)) for n in sizes.values())
    rates = {s: len(rows) * math.sqrt(n / len(rows)) / whole / n for s, n in sizes.items()}
    wanted = Counter()
    for doc, source, _, _ in rows:
        for copy in range(draws(rates[source], doc)):
            wanted[doc, source, copy] += 1
    assert Counter((r.doc_id, r.source, r.copy_) for r in got.collect()) == wanted


def test_given_weights_set_the_mixture(spark):
    frame = spark.range(6000).selectExpr("id AS doc_id", "CASE WHEN id % 10 = 0 THEN 'a' WHEN id % 10 < 9 THEN 'b' END AS source")
    got = Counter(r.source for r in source_mixing.mix(frame, "doc_id", "source", weights={"a": 3, "b": 1, "unknown": 0}, size=4000).collect())
    assert set(got) == {"a", "b"} and got["a"] == pytest.approx(3000, rel=0.1) and got["b"] == pytest.approx(1000, rel=0.15)
    large = source_mixing.mix(frame.where("source = 'a'"), "doc_id", "source", size=600_000)
    assert large.count() == pytest.approx(600_000, rel=0.02)


def test_mixing_no_rows_keeps_the_columns(none):
    got = source_mixing.mix(none, "doc_id", "source", copy=None)
    assert got.columns == none.columns and got.count() == 0


CHAT = [
    (1, 0, "user", "How do I bake bread?\n\nI have no oven."),
    (1, 1, "assistant", "Use a pan."),
    (1, 2, "user", ">  how do I BAKE bread?\nStill not clear."),
    (1, 3, "assistant", "> > I have no oven.\n> Still not clear.\n\nTry   steam.\nIt works."),
    (1, 4, "user", "> Use a pan.\nWhich pan?"),
    (1, 5, "user", "> It works.\n> > > I have no oven.\nThanks"),
    (1, 6, "user", "> never said\nHm"),
    (2, 0, "user", "> Use a pan.\nanother conversation"),
    (2, 1, None, None), (2, 2, "user", ""), (None, 0, "user", "alone"), (None, 1, "user", "> alone\nreply"), (2, None, "user", "no turn"),
    (1, 4, "user", "> Use a pan.\nWhich pan?"),
]


@pytest.fixture(scope="module")
def chat(spark):
    return spark.createDataFrame([(*row, 0) for row in CHAT], "conv_id long, turn long, role string, text string, position int")


def test_quotes_link_to_their_originals(chat):
    rows = quotation_threads.conversations(chat, "conv_id", "turn", "role", "text").collect()
    assert len(rows) == len(CHAT)
    by = {(r.conv_id, r.turn): r for r in rows}
    assert {k: r.parent for k, r in by.items() if r.parent is not None} == {(1, 2): 0, (1, 3): 2, (1, 4): 1, (1, 5): 3, (None, 1): 0}
    assert [by[1, t].root for t in range(7)] == [0, 1, 0, 0, 1, 0, 6]
    assert [by[1, t].depth for t in range(7)] == [0, 0, 1, 2, 1, 3, 0]
    order = [r.turn for r in sorted((r for r in rows if r.conv_id == 1), key=lambda r: r.position)]
    assert order == [0, 2, 3, 5, 1, 4, 4, 6]
    assert by[1, 3].body == "Try   steam.\nIt works." and by[1, 5].body == "Thanks" and by[1, 0].body == CHAT[0][3]
    assert by[2, 1].body is None and by[2, 1].formatted == "<|unknown|>\n" and by[2, 2].body == ""
    assert by[1, 4].formatted == "<|user|>\nWhich pan?"


def test_chat_equals_sql(spark, chat, tmp_path):
    chat.drop("position").where("conv_id IS NOT NULL").coalesce(1).write.parquet(str(tmp_path / "chat"))
    db = duckdb.connect()
    db.execute(f"CREATE OR REPLACE VIEW conversations AS SELECT * FROM read_parquet('{tmp_path}/chat/*.parquet')")
    theirs = sorted(db.execute(ORACLE["op10_quotation_threads"]).fetchall(), key=repr)
    ours = quotation_threads.conversations(chat.where("conv_id IS NOT NULL"), "conv_id", "turn", "role", "text").collect()
    assert sorted(map(tuple, ours), key=repr) == theirs


def test_chat_of_random_quotes_equals_sql(spark, tmp_path):
    """Whole, partial, nested and repeated quotes of several conversations, one of them with a third of all rows."""
    import random

    pick = random.Random(5)
    said = ["Is it so?", "It is. Yes!", "One  two", "three four", "你好。再见！ 好", "", "  ", "No."]
    rows, history = [], {}
    for turn in range(240):
        conv = 0 if turn % 3 == 0 else pick.randrange(1, 9)
        lines = []
        for _ in range(pick.randrange(3)):
            source = pick.choice(history.get(conv) or ["never said"]).split("\n")
            start = pick.randrange(len(source))
            marks = pick.choice(["> ", ">", "> > ", " >"])
            lines += [marks + line.upper() for line in source[start : start + pick.randrange(1, 4)]]
        lines += [" ".join(pick.choices(said, k=2)) + pick.choice(["", f" {turn}."]) for _ in range(pick.randrange(1, 5))]
        text = "\n".join(lines)
        history.setdefault(conv, []).append(text)
        rows += [(conv, turn, pick.choice(["user", "assistant"]), text)] * pick.choice([1, 1, 2])
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").coalesce(1)
    frame.write.parquet(str(tmp_path / "chat"))
    db = duckdb.connect()
    db.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{tmp_path}/chat/*.parquet')")
    result = db.execute(ORACLE["op10_quotation_threads"])
    names = [d[0] for d in result.description]
    theirs = sorted(result.fetchall(), key=repr)
    ours = sorted(map(tuple, quotation_threads.conversations(frame, "conv_id", "turn", "role", "text").select(names).collect()), key=repr)
    assert ours == theirs
    parent = names.index("parent")
    assert sum(row[parent] is not None for row in ours) > 60


def test_chat_of_no_rows(chat):
    assert quotation_threads.conversations(chat.where("turn > 99"), "conv_id", "turn", "role", "text").count() == 0


@pytest.fixture(scope="module")
def stages(spark, sf_dir, tmp_path_factory):
    """Input and output of every stage, each written and read again."""
    docs, out = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        stage(spark, docs, sf_dir).write.parquet(path)
        out.append((docs, spark.read.parquet(path)))
        docs = out[-1][1]
    return out


def test_stages_keep_the_columns(stages):
    assert len(corpus_pipeline.STAGES) == 5
    for docs, kept in stages[:-1]:
        assert dict(kept.dtypes) == dict(docs.dtypes)


def test_stages_one_document_at_a_time(spark, sf_dir, stages):
    docs, good = stages[0]
    accepted = {r.doc_id for r in queries.op1_quality_classifier(spark, sf_dir).where("predicted = 1").collect()}
    assert {r.doc_id for r in good.collect()} == accepted and good.count() == len(accepted) < docs.count()

    from test_groups_of_texts import five_word_links, joined

    good, single = stages[1]
    texts = {r.doc_id: r.text for r in good.collect()}
    root = joined(five_word_links(texts), sorted(texts))
    assert sorted(r.doc_id for r in single.collect()) == sorted(set(root.values())) and single.count() < good.count()

    single, clean = stages[2]
    before = {r.doc_id: r.text for r in single.collect()}
    after = {r.doc_id: r for r in clean.collect()}
    assert set(before) == set(after) and any(before[i] != after[i].text for i in before)
    assert all(r.n_chars == len(r.text) for r in after.values())
    left = personal_data.spans(clean, "doc_id", "text").where("size(base) > 0")
    assert left.count() == 0

    clean, mixed = stages[3]
    assert {r.doc_id for r in mixed.collect()} <= set(after)

    import sentencepiece

    processor = sentencepiece.SentencePieceProcessor(model_file=queries.model_path())
    mixed, pieces = stages[4]
    wanted = Counter((r.doc_id, tuple(processor.encode(r.text, add_bos=True, add_eos=True))) for r in mixed.collect())
    from array import array

    assert Counter((r.doc_id, tuple(array("I", r.ids))) for r in pieces.collect()) == wanted


def test_run_equals_the_stages(spark, sf_dir, stages):
    rows = corpus_pipeline.run(spark, sf_dir).select("doc_id", "n_tokens").collect()
    assert sorted(map(tuple, rows)) == sorted((r.doc_id, r.n_tokens) for r in stages[4][1].collect())


def test_near_duplicate_stage_keeps_rows_without_an_id(spark, edges):
    docs = edges.select("doc_id", "text", "lang", "source", "n_chars")
    kept = corpus_pipeline.near_duplicates(spark, docs, "").collect()
    ids = [r.doc_id for r in kept]
    assert ids.count(None) == 1 and len(ids) == len(set(ids)) and 5 in ids and 6 not in ids


def test_stages_on_clashing_names_and_empty_tables(spark, sf_dir, edges, none):
    clash = edges.withColumnsRenamed({"tag": "_key", "_row": "_rank"})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, clash, sf_dir)
        assert kept.columns == clash.columns, name
        rows = kept.collect()
        assert all((r["_key"], r["_rank"]) == (-1, "clash") for r in rows), name
        assert stage(spark, none, sf_dir).count() == 0, name
    assert corpus_pipeline.pieces(spark, none, sf_dir).count() == 0


def test_partial_quotes_link_to_their_originals(spark):
    rows = [
        (1, 0, "First line\nsecond line\nthird line"),
        (1, 1, "One paragraph here.\n\nAnother one.\n\nA last one."),
        (1, 2, "This is it. Is it not? It is so."),
        (1, 3, "> second line\n> third line\nYes"),
        (1, 4, "> One paragraph here.\n>\n> Another one.\nNo"),
        (1, 5, "> Is it not?\nMaybe"),
        (1, 6, "> third line\n> This is it. Is it not?\nThe longest part decides"),
        (1, 7, "> unknown words\nNothing"),
    ]
    frame = spark.createDataFrame([(c, t, "user", x) for c, t, x in rows], "conv_id long, turn long, role string, text string")
    got = {r.turn: r.parent for r in quotation_threads.conversations(frame, "conv_id", "turn", "role", "text").collect()}
    assert got == {0: None, 1: None, 2: None, 3: 0, 4: 1, 5: 2, 6: 2, 7: None}
