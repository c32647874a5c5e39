"""Near-duplicates, benchmark decontamination and licence scans against brute force."""

import random
import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from brightloom.llm import common, decontaminate, license_scan, near_dedup

EXTRA = "doc_id long, text string, cls long, h long, token long, unit string"
ODD = [(1, None), (2, ""), (3, " \n "), (4, "One two"), (5, "one TWO"), (6, "one"), (None, "one two"), (None, None), (8, "w " * 150000), (8, "w " * 150000)]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, 2, 3, "u") for i, t in rows], EXTRA)


def shingles(text, width):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
    return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())


def brute_groups(rows, width, percent):
    sets = [(i, shingles(t, width)) for i, t in rows]
    comp = {i: i for i, _ in rows}

    def root(i):
        while comp[i] != i:
            i = comp[i]
        return i

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = root(i), root(j)
                comp[max(x, y)] = min(x, y)
    return {i: (len(s), root(i)) for i, s in sets}


def edited(rng, words, share):
    return [rng.choice("abcdefghij") * 9 + str(rng.random()) if rng.random() < share else w for w in words]


def planted(seed):
    """Groups of near copies with many different numbers of edits, exact copies, and a passage that most texts share."""
    rng = random.Random(seed)
    passage = [f"p{i}" for i in range(40)]
    texts = []
    for g in range(6):
        base = [f"g{g}w{rng.randrange(400)}" for _ in range(120)]
        texts += [edited(rng, base, rng.choice([0, 0.005, 0.01, 0.02, 0.03, 0.05, 0.08])) for _ in range(25 if g else 150)]
    texts += [passage + [f"u{rng.randrange(10**6)}" for _ in range(rng.randrange(5, 60))] for _ in range(150)]
    texts += [list(t) for t in rng.sample(texts, 40)]
    rng.shuffle(texts)
    return [(i, " ".join(t)) for i, t in enumerate(texts)]


@pytest.mark.parametrize("width,percent,block", [(3, 85, 256), (5, 80, 16)])
def test_groups_match_brute_force(spark, width, percent, block):
    rows = planted(width)
    want = brute_groups(rows, width, percent)
    got = near_dedup.duplicate_groups(frame(spark, rows), width=width, percent=percent, block=block).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_groups_of_odd_rows(spark):
    got = near_dedup.duplicate_groups(frame(spark, ODD), width=3, percent=85).collect()
    assert len(got) == len(ODD)
    by = {r["doc_id"]: r for r in got if r["doc_id"] is not None}
    assert [by[i]["n_shingles"] for i in (1, 2, 3, 4, 6, 8)] == [0, 0, 0, 1, 1, 1]
    assert [by[i]["component_id"] for i in (1, 2, 3, 4, 5, 6, 8)] == [1, 2, 3, 4, 4, 6, 8]
    assert sorted((r["n_shingles"], r["component_id"] or 0, r["kept"]) for r in got if r["doc_id"] is None) == [(0, 0, True), (1, 4, False)]
    assert near_dedup.duplicate_groups(frame(spark, ODD).limit(0)).count() == 0


def test_one_row_of_each_group_stays(spark):
    rows = [(1, "a b c d e f g"), (2, "A b c d e f g"), (2, "A b c d e f g"), (3, "x y z u v w"), (3, "x y z u v w"), (4, None), (5, "q")]
    kept = near_dedup.drop_near_duplicates(frame(spark, rows))
    assert kept.columns == ["doc_id", "text", "cls", "h", "token", "unit"]
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 3, 4, 5]


def test_match_threshold_misses_little():
    from math import comb

    for k, t in ((48, 0.85), (48, 0.8), (16, 0.9)):
        c = near_dedup.match_threshold(k, t, 1e-5)
        tail = lambda c: sum(comb(k, i) * t**i * (1 - t) ** (k - i) for i in range(c))  # noqa: B023, E731
        assert tail(c) <= 1e-5 < tail(c + 1)


def test_components_of_long_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(i, 200) for i in range(201, 240)] + [(7, 3), (3, 9), (9, 7), (5, 5)]
    got = {r["node"]: r["comp"] for r in near_dedup.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 100 for i in range(100, 161)} | {i: 200 for i in range(200, 240)} | {3: 3, 7: 3, 9: 3}


def containment(doc, item, width=5):
    """Share of the item's shingles in the document; items of fewer words are one shingle of as many words."""
    d, i = ([w for w in (x.strip(decontaminate.PUNCTUATION) for x in (t or "").lower().split()) if w] for t in (doc, item))
    width = max(1, min(width, len(i)))
    sets = [{tuple(w[k : k + width]) for k in range(len(w) - width + 1)} for w in (d, i)]
    return len(sets[0] & sets[1]) / len(sets[1]) if sets[1] else 0


def test_contained_items_match_brute_force(spark):
    rng = random.Random(5)
    items = [(i, " ".join(f"i{i}x{j}" for j in range(n))) for i, n in enumerate([1, 3, 5, 6, 9, 17, 40, 64, 65, 100])] + [(20, None), (21, " ")]
    docs = []
    for d in range(120):
        i, t = rng.choice(items[:10])
        w = t.split()
        drop = set(rng.sample(range(len(w)), min(len(w), rng.choice([0, 0, 1, 2, 3]))))
        w = [x.upper() + "," if rng.random() < 0.2 else x for k, x in enumerate(w) if k not in drop]
        noise = [f"n{rng.random()}" for _ in range(rng.randrange(1, 300))]
        at = rng.randrange(len(noise))
        docs.append((d, " ".join(noise[:at] + w + noise[at:])))
    docs += [(200, None), (201, ""), (202, items[6][1]), (202, items[6][1]), (203, "i0x0 " * 50000)]
    got = decontaminate.find_contained(frame(spark, docs), spark.createDataFrame(items, "item_id long, text string")).collect()
    want = {(d, i) for d, t in docs for i, s in items if containment(t, s) >= 0.8}
    assert len(got) == len(want) and {(r["doc_id"], r["item_id"]) for r in got} == want
    kept = decontaminate.drop_contaminated(frame(spark, docs), spark.createDataFrame(items, "item_id long, text string"))
    assert kept.columns == ["doc_id", "text", "cls", "h", "token", "unit"]
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(d for d, _ in docs if d not in {p[0] for p in want})
    assert decontaminate.find_contained(frame(spark, docs).limit(0), spark.createDataFrame(items, "item_id long, text string")).count() == 0
    assert decontaminate.find_contained(frame(spark, docs), spark.createDataFrame([], "item_id long, text string")).count() == 0


def test_short_items_are_found_inside_long_documents(spark):
    items = [(1, "alpha"), (2, "Beta gamma"), (3, "one two, three four"), (4, "one two three four five")]
    filler = " ".join(f"w{i}" for i in range(300))
    docs = [(1, f"{filler} ALPHA! {filler}"), (2, f"{filler} beta gamma"), (3, f"gamma beta {filler}"), (4, "one two three four"), (5, f"one two three four {filler}"), (6, "alpha"), (7, f"x one two three four five {filler}")]
    got = decontaminate.find_contained(frame(spark, docs), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert sorted((r["doc_id"], r["item_id"], r["n_item"], r["n_found"]) for r in got) == [(1, 1, 1, 1), (2, 2, 1, 1), (4, 3, 1, 1), (5, 3, 1, 1), (6, 1, 1, 1), (7, 3, 1, 1), (7, 4, 1, 1)]


def test_pairs_meet_in_a_list_although_short_values_collide():
    """Two members agree on 47 of 48 coordinates; the other one is equal in 15 bits only, and both are posted there."""
    x = np.arange(48, dtype=np.int32) * 7 + 3
    y = x.copy()
    y[0] += 32768
    mask = (1 << 0) | (1 << 5)
    rows = [{"token": (5 << 32) + int(x[5]), "xb": 0, "yb": 0, "cls": c, "comp": c, "mask": mask, "sig": v, "side": side} for c, v, side in ((1, x, 1), (2, y, 0))]
    got = pd.concat(near_dedup._matching(30)(iter([pd.DataFrame(rows)])))
    assert sorted(got["cls"]) == [1, 2]


def test_licences(spark):
    mit = license_scan.NOTICES["MIT-text"]
    rows = [
        (1, "Some text\nReleased under the MIT license\nmore"),
        (2, mit.upper()),
        (3, mit.replace(". ", ".\n")),
        (4, "released under a licence of my own"),
        (5, None),
        (6, ""),
        (7, "licence " * 100000),
        (8, "All rights reserved."),
        (8, "All rights reserved."),
    ]
    got = sorted((r["doc_id"], r["unit"], r["position"], r["licence"]) for r in license_scan.scan_licences(frame(spark, rows)).collect())
    assert got == [(1, "line", 1, "MIT"), (2, "line", 0, "MIT-text"), (3, "text", -1, "MIT-text"), (8, "line", 0, "reserved"), (8, "line", 0, "reserved")]
    assert license_scan.scan_licences(frame(spark, rows).limit(0)).count() == 0
    wide = license_scan.scan_licences(frame(spark, rows), threshold=0.01).filter("doc_id = 4")
    w = lambda t: {(a, b) for x in [re.findall("[a-z0-9]+", t.lower())] for a, b in zip(x, x[1:])}
    for r in wide.collect():
        a, b = w(rows[3][1]), w(license_scan.NOTICES[r["licence"]])
        assert r["dice"] == pytest.approx(2 * len(a & b) / (len(a) + len(b)))
    assert wide.count() > 0 and wide.select(F.max("dice")).first()[0] < 0.8


def test_rows_in_and_not_in_tables_of_keys(spark):
    rows = [(i if i % 7 else None, f"t{i}") for i in range(500)] + [(3, "again")]
    df = frame(spark, rows)
    keys = spark.createDataFrame([(k,) for k in [3, 4, 4, 499, 10**12, None]], "cls long")
    inside, outside = common.rows_in(df, "doc_id", keys), common.rows_not_in(df, "doc_id", keys)
    assert inside.columns == outside.columns == df.columns
    wanted = {3, 4, 499, None}
    assert sorted(r["text"] for r in inside.collect()) == sorted(t for i, t in rows if i in wanted)
    assert sorted(r["text"] for r in outside.collect()) == sorted(t for i, t in rows if i not in wanted)
    none = keys.limit(0)
    assert common.rows_in(df, "doc_id", none).count() == 0 and common.rows_not_in(df, "doc_id", none).count() == len(rows)


def test_licences_inside_texts(spark):
    code = "\n".join(f"def f{i}(x{i}): return x{i} + {i}" for i in range(60))
    wrap = lambda t, mark: "\n".join(mark + " " + " ".join(t.split()[i : i + 9]) for i in range(0, len(t.split()), 9))
    n = license_scan.NOTICES
    rows = [
        (1, "# Copyright 2020 X\n" + wrap(n["Apache-2.0-2"], "#") + "\n" + code),
        (2, code + "\n" + wrap(n["MIT-text"], " *") + "\n" + code),
        (3, "Copyright (c) 2020 X. All rights reserved. And more words follow here."),
        (4, f"a b c {wrap(n['GPL-3.0-2'], '//')} d e f\n{code}\n{' '.join(code.split())} {n['GPL-3.0-2']} {' '.join(code.split())}"),
        (5, code + "\nReleased under the MIT License.\n" + code),
        (6, code + "\nall of the rights are reserved under the terms of this work\n" + code),
    ]
    got = sorted((r["doc_id"], r["unit"], r["licence"]) for r in license_scan.scan_licences(frame(spark, rows)).collect() if r["unit"] == "run")
    assert got == [(1, "run", "Apache-2.0-2"), (2, "run", "MIT-text"), (3, "run", "reserved"), (4, "run", "GPL-3.0-2"), (4, "run", "GPL-3.0-2")]
    at = {r["doc_id"]: (r["position"], r["dice"]) for r in license_scan.scan_licences(frame(spark, rows)).filter("unit = 'run' AND doc_id IN (2, 3)").collect()}
    assert at[3] == (4, 1.0) and at[2] == (len(re.findall("[a-z0-9]+", code.lower())), 1.0)
