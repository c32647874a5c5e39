"""Chat formatting, source mixing, the pipeline and the registered queries."""

import hashlib
import math
import warnings

import pytest
from oracle import compare, connect
from pyspark.sql import functions as F

import corpus_pipeline
from brightloom.llm import chat_format, decontaminate, language_id, near_dedup, queries, source_mix, toxicity
from brightloom.plans.common import table
from test_duplicates_and_leaks import brute_groups, containment

SMALL, SF = "/root/testdata/sf0.001", "/root/testdata/sf0.01"

TURNS = [
    (1, 0, "system", "<turn x>\n</turn>\n"),
    (1, 1, "user", "\\l \\\\b <b> \\g"),
    (1, 2, "assistant", "a < b > c \\ d\n"),
    (1, 3, "user", None),
    (1, 4, "assistant", "</turn>\n<turn assistant>\nx"),
    (2, 0, "user", "only"),
    (3, 0, "assistant", ""),
    (None, 5, None, "é\U0001f600"),
    (None, None, "assistant", "null turn"),
    (4, 1, "user", "same"),
    (4, 1, "user", "same"),
    (5, 0, "assist>\nant", "role"),
    (6, 0, "user", "long " * 100000),
    (6, 1, "assistant", "reply " * 100000),
]


def test_conversations_round_trip(spark):
    df = spark.createDataFrame([(*t, "f", "e") for t in TURNS], "conv_id long, turn long, role string, text string, formatted string, examples string")
    made = chat_format.format_conversations(df)
    back = {r["conv_id"]: r for r in made.select("*", chat_format.parse_turns(F.col("formatted")).alias("turns")).collect()}
    digests = {r["conv_id"]: r for r in chat_format.conversation_digests(made).collect()}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    for conv in {t[0] for t in TURNS}:
        own = sorted((t for t in TURNS if t[0] == conv), key=lambda t: (t[1] is not None, t[1] or 0, t[2] or "", t[3] or ""))
        assert [(t["role"], t["text"]) for t in back[conv]["turns"]] == [(t[2] or "", t[3] or "") for t in own]
        loss = "".join(t[3] or "" for t in own if t[2] == "assistant")
        d = digests[conv]
        assert (d["n_turns"], d["loss_chars"], d["loss_sha256"]) == (len(own), len(loss), sha(loss))
        assert d["turns_sha256"] == sha("".join(f"{t[2] or ''}\n{t[3] or ''}\n" for t in own)) and d["formatted_chars"] == len(back[conv]["formatted"])
    for r in chat_format.example_texts(made).collect():
        assert back[r["conv_id"]]["formatted"].startswith(r["context"] + r["target"] + "</turn>\n") and r["context"].endswith("<turn assistant>\n")
    spans = {(r["conv_id"], r["example"]): r["target"] for r in chat_format.explode_examples(made).collect()}
    assert spans == {(r["conv_id"], r["example"]): r["target"] for r in chat_format.example_texts(made).collect()} and len(spans) == 5
    assert chat_format.conversation_digests(chat_format.format_conversations(df.limit(0))).count() == 0


def docs_of(spark, sizes):
    rows = [(i, s, " ".join("w" * n) if n is not None else None, "c", 1) for i, (s, n) in enumerate(sizes)]
    return spark.createDataFrame(rows, "doc_id long, source string, text string, size string, sid int")


def brute_targets(sizes, weights=(3, 1, 2)):
    total = {}
    for s, n in sizes:
        total[s] = total.get(s, 0) + (n or 0)
    names = sorted((s for s in total if s is not None)) + [None] * (None in total)
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    budget, full = 1.5 * sum(total.values()), set()
    while len(full) < len(names):
        level = (budget - sum(2 * total[s] for s in full)) / sum(weight[s] for s in names if s not in full)
        more = {s for s in names if s not in full and weight[s] * level > 2 * total[s]}
        if not more:
            break
        full |= more
    return {s: 2.0 * total[s] if s in full else weight[s] * level for s in names}


def test_mix_meets_its_targets(spark):
    sizes = [("b", 1 + i * 7 % 90) for i in range(400)] + [("a", 5 + i % 40) for i in range(300)] + [("", 30)] * 500 + [(None, 2 + i) for i in range(60)] + [("é", 10)] * 3
    sizes += [("z", 0), ("z", None), ("b", 3000), ("Z", 17)]
    rows = source_mix.mix_sources(docs_of(spark, sizes)).collect()
    again = source_mix.mix_sources(docs_of(spark, sizes).repartition(5)).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again)) and len(rows) == len(sizes)
    want = brute_targets(sizes)
    taken, source_size = {}, {}
    for r in rows:
        s, n = sizes[r["doc_id"]]
        assert r["size"] == (n or 0) and 0 <= r["taken"] <= 2 * r["size"] and r["taken"] == r["size"] * r["copies"]
        assert r["target"] == pytest.approx(want[s])
        taken[s] = taken.get(s, 0) + r["taken"]
        source_size[s] = r["source_size"]
    for s, t in want.items():
        smallest = min((n for x, n in sizes if x == s and n), default=0)
        assert abs(taken[s] - t) <= max(smallest, 0.005 * t), s
        assert source_size[s] == sum(n or 0 for x, n in sizes if x == s)


def test_rates_solve_the_dual(spark):
    cells = [(0, n, c, n / 20, 1500.0) for n, c in ((10, 20), (20, 10), (40, 20))] + [(1, 7, 3, 1.0, 41.9)] + [(2, 5, 4, 1.0, 1.0)]
    lam = {r["sid"]: r["lam"] for r in source_mix.solve_rates(spark.createDataFrame(cells, "sid long, size long, n long, z double, target double"), 2.0).collect()}
    for sid, target in ((0, 1500.0), (1, 41.9), (2, 1.0)):
        got = sum(c * n * min(2.0, math.exp(lam[sid] * z)) for s, n, c, z, _ in cells if s == sid)
        assert got == pytest.approx(target, rel=1e-6)


def test_mix_of_empty_tables(spark):
    assert source_mix.mix_sources(docs_of(spark, [("a", 1)]).limit(0)).count() == 0
    rows = source_mix.mix_sources(docs_of(spark, [("a", 0), (None, None)])).collect()
    assert [(r["size"], r["taken"], r["target"]) for r in rows] == [(0, 0, 0.0)] * 2


def test_pipeline_stages_match_their_parts(spark):
    docs = table(spark, SMALL, "documents").cache()
    names = docs.columns
    for (name, stage), (_, following) in zip(corpus_pipeline.STAGES, corpus_pipeline.STAGES[1:]):
        out = stage(spark, docs, SMALL).cache()
        assert out.columns == names
        before, after = {r["doc_id"]: r["text"] for r in docs.collect()}, {r["doc_id"] for r in out.collect()}
        if name == "near_duplicates":
            want = {i for i, (_, g) in brute_groups(list(before.items()), 5, 80).items() if g == i}
        elif name == "decontamination":
            items = [r["text"] for r in table(spark, SMALL, "benchmark").collect()]
            want = {i for i, t in before.items() if not any(containment(t, x) >= 0.8 for x in items)}
        elif name == "toxicity":
            want = {r["doc_id"] for r in toxicity.score_severity(docs, table(spark, SMALL, "labels")).filter("NOT rejected").collect()}
        else:
            want = {r["doc_id"] for r in language_id.identify_languages(docs).filter("lang_pred <> 'und' AND score >= 0.5").collect()}
        assert after == want and len(after) > 0.7 * len(before), name
        docs = out
    kept = {r["doc_id"] for r in docs.collect()}
    result = corpus_pipeline.run(spark, SMALL).collect()
    assert {r["doc_id"] for r in result} == kept and len(result) == len(kept)


def test_pipeline_of_odd_rows(spark):
    rows = [(None, None, None, None, None), (1, "", "en", None, 0), (1, "", "en", None, 0), (2, "the and of " * 30000, None, "s", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for df, most in ((docs, 4), (docs.limit(0), 0)):
        for _, stage in corpus_pipeline.STAGES:
            df = stage(spark, df, SMALL)
            assert df.count() <= most


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_registered_query(spark, name):
    got = queries.QUERIES[name](spark, SMALL).toArrow()
    assert got.num_rows > 0
    if name in queries.ORACLES:
        with warnings.catch_warnings():
            warnings.simplefilter("ignore")
            assert compare(got, connect(SMALL).execute(queries.ORACLES[name]).to_arrow_table()) == []


def test_every_number_has_one_query():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
    assert corpus_pipeline.ORACLE_SQL is None and len(corpus_pipeline.STAGES) == 5
    assert near_dedup.match_threshold(48, 0.85, 1e-5) > 24 and decontaminate.PUNCTUATION
