"""Token-ID files, bit-plane clusters and spelling variants against brute force."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from brightloom.llm import plane_clusters, spelling, token_files
from brightloom.session import fresh_path

BPE = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")


# token files


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.sampled_from([1, 3, 100, 5000, 50257, 1 << 31, (1 << 60) - 1, 1 << 60, (1 << 64) - 1]), st.integers(1, 300)), max_size=8), st.sampled_from([1, 7, 64, 4096]))
def test_packing_is_exact_and_blocks_are_independent(runs, block):
    rng = np.random.default_rng(0)
    ids = np.concatenate([np.zeros(0, np.uint64), *[rng.integers(0, top, n, dtype=np.uint64, endpoint=True) for top, n in runs]])
    words, offsets, escapes = token_files.pack(ids, block)
    assert (token_files.unpack(words, escapes) == ids).all()
    assert len(escapes) == (ids >= 1 << 60).sum()
    for b in range(len(offsets) - 1):
        assert (token_files.unpack(words[offsets[b] : offsets[b + 1]], escapes) == ids[b * block : (b + 1) * block]).all()


def test_words_hold_as_many_ids_as_fit():
    for count, width in list(zip(token_files.COUNTS, token_files.WIDTHS))[1:]:
        ids = np.full(count * 3, (1 << width) - 1, np.uint64)
        words, _, _ = token_files.pack(ids)
        assert len(words) <= 3 if width else len(words) == 3
    assert len(token_files.pack(np.arange(4096, dtype=np.uint64))[0]) * 8 < 4096 * 2


def test_records_read_by_block():
    ids = np.arange(10_000, dtype=np.uint64) * 7 % 50_000
    data = token_files.make_record([5, None, -3], [4000, 0, 6000], ids) + b"\n"
    first, second = token_files.records(data + data)
    assert first.keys == [5, None, -3] and first.lengths.tolist() == [4000, 0, 6000]
    assert (second.ids() == ids).all() and (first.block(1) == ids[4096:8192]).all()
    with pytest.raises(ValueError):
        list(token_files.records(b"x" + data))


HARD = ["", " ", "  a", "a  b ", "it's, 'tis. don't\n\nx", "<|endoftext|> x <|endoftext|>.", "é è́ x ß, ÿ!", "x × y÷ z", "　a b", "a\tb c \n d", "foo ( bar ) 12 34.5 ½ ²; w? x:", "日本 語 a, b", "a\nb\n\nc\n\n\nd\n", "\na", "\n", "x.\nY, z\n", "a \nb", "a\n b", "w*** é%%% (a|b| c<|endoftext|>d| _x_ y_", "it's.\nIt's"]


def test_encoder_equals_the_library_on_whole_texts():
    rng = np.random.default_rng(1)
    parts = [*"ab '.,;s1é×\n\n*|_\n\t日ß(!?:|", "<|endoftext|>", " the", "\xa0"]
    texts = HARD + ["".join(rng.choice(parts, rng.integers(1, 40))) for _ in range(3000)] + ["lorem ipsum, dolor. " * 20_000]
    for path, special in ((BPE, False), (BPE, True), (WORDS, False)):
        with open(path) as f:
            encoder = token_files.TextEncoder(f.read(), special, most=2000)
        plain = Tokenizer.from_file(path)
        plain.encode_special_tokens = special
        assert encoder.cuts == (path == BPE)
        for part in (texts[:500], texts[500:], texts[:3]):
            ids, sizes = encoder(part, 2)
            ends = np.cumsum(sizes)
            for want, n, end in zip(plain.encode_batch(part, add_special_tokens=False), sizes, ends):
                assert [*want.ids, 2] == ids[end - n : end].tolist()


def digests(rows):
    """From the library's ids of whole texts, one after the other."""
    tokenizer, at, out = Tokenizer.from_file(BPE), 0, []
    for key, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((key, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def test_files_of_a_corpus(spark):
    rows = [(i * 3 % 101 - 20, t) for i, t in enumerate((HARD * 9)[:101])] + [(1000, None), (1001, "long " * 50_000)]
    df = spark.createDataFrame([(k, t, 1, 2, 3) for k, t in rows], "doc_id long, text string, start int, ids int, file int").repartition(5)
    path = fresh_path(spark, "t")
    token_files.write_token_files(df, path, BPE, file_chars=40_000, record_chars=500)
    got = token_files.token_digests(spark, path).orderBy("doc_id").collect()
    assert [tuple(r) for r in got] == digests(sorted(rows))
    assert token_files.read_token_files(spark, path).select("file").distinct().count() > 3


def test_null_and_repeated_keys(spark):
    df = spark.createDataFrame([(None, "b a"), (7, "x"), (7, "x"), (7, "y z"), (None, None)], "doc_id long, text string")
    path = fresh_path(spark, "t")
    token_files.write_token_files(df, path, BPE)
    got = [tuple(r) for r in token_files.token_digests(spark, path).orderBy("start").collect()]
    assert [r[0] for r in got] == [None, None, 7, 7, 7] and [r[1] for r in got] == np.cumsum([0, *[r[2] for r in got[:-1]]]).tolist()
    assert sorted((str(r[0]), *r[2:]) for r in got) == sorted((str(r[0]), *r[2:]) for r in digests([tuple(r) for r in df.collect()]))


def test_no_documents(spark):
    path = fresh_path(spark, "t")
    token_files.write_token_files(spark.createDataFrame([], "doc_id long, text string"), path, BPE)
    assert token_files.token_digests(spark, path).count() == 0


# bit planes


@settings(max_examples=40, deadline=None)
@given(st.integers(1, 27), st.integers(0, 1 << 30))
def test_plane_arithmetic_is_exact(bits, seed):
    rng = np.random.default_rng(seed)
    x = rng.integers(-(1 << bits), 1 << bits, (20, 64))
    planes = plane_clusters.to_planes(x, bits + 1)
    assert (plane_clusters.products(planes, planes[:5]) == x @ x[:5].T).all()
    assert (plane_clusters.squares(planes) == (x * x).sum(1)).all()
    assert (plane_clusters.plane_sums(planes) == x.sum(0)).all()


def brute_kmeans(rows, k=8, rounds=10):
    x = {key: [int(np.floor(1024 * float(np.float32(c)))) for c in v] for key, v in rows}
    starts = sorted(x, key=lambda key: hashlib.sha256(f"3:{key}".encode()).hexdigest())[:k]
    centroids = [list(x[key]) for key in starts]

    def assign():
        return {key: min((sum((a - b) ** 2 for a, b in zip(v, c)), i) for i, c in enumerate(centroids)) for key, v in x.items()}

    for _ in range(rounds):
        own = assign()
        for i in range(len(centroids)):
            mine = [x[key] for key, (_, c) in own.items() if c == i]
            if mine:
                centroids[i] = [sum(col) // len(mine) for col in zip(*mine)]
    own = assign()
    of = Counter()
    for d, c in own.values():
        of[c] += d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return {(key, c, d, of[c], sum(of.values()), sha[c]) for key, (d, c) in own.items()}


def test_clusters_equal_brute_force(spark):
    rng = np.random.default_rng(2)
    rows = [(i, (rng.normal(size=64) + 3 * (i % 5)).astype(np.float32).tolist()) for i in range(150)] + [(i, [0.25] * 64) for i in range(200, 260)]
    bad = [(300, [1.0] * 63), (301, [1.0] * 63 + [None]), (302, [1.0] * 63 + [float("nan")]), (303, [1.0] * 63 + [float("inf")]), (304, None)]
    df = spark.createDataFrame([(k, v, 9, "x") for k, v in rows + bad], "vec_id long, embedding array<float>, cluster int, inertia string").repartition(7)
    got = {tuple(r) for r in plane_clusters.cluster_vectors(df, "vec_id").collect()}
    assert got == brute_kmeans(rows)


def test_few_or_no_vectors(spark):
    rows = [(i, [float(i)] * 64) for i in range(3)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert {tuple(r) for r in plane_clusters.cluster_vectors(df, "vec_id").collect()} == brute_kmeans(rows)
    assert plane_clusters.cluster_vectors(df.filter("vec_id > 9"), "vec_id").count() == 0
    twice = plane_clusters.cluster_vectors(df.unionAll(df).unionAll(spark.createDataFrame([(None, [9.0] * 64)], df.schema)), "vec_id", k=2).collect()
    assert len(twice) == 7 and {r["vec_id"] for r in twice} == {0, 1, 2, None}


def test_components_too_large_for_exact_distances(spark):
    df = spark.createDataFrame([(1, [1e9] * 64)], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="too large"):
        plane_clusters.cluster_vectors(df, "vec_id").collect()


# spelling


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_forms(rows, shortest=6, least=5, period=199, ratio=5):
    counts = Counter()
    low = {i: i + 32 for i in range(65, 91)}
    for key, text in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = w.translate(low)
            h = zlib.crc32(f"{'' if key is None else key}:{w}".encode())
            if h % period == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            counts[w] += 1
    n = {w: c for w, c in counts.items() if c >= least and len(w) >= shortest}
    by_length = defaultdict(list)
    for w in n:
        by_length[len(w)].append(w)
    near = {w: [v for s in (-1, 0, 1) for v in by_length[len(w) + s] if one_edit(w, v)] for w in n}
    form = {}
    for w, others in near.items():
        if others:
            best = min(others, key=lambda v: (-n[v], v))
            if n[best] >= ratio * n[w]:
                form[w] = best

    def root(w):
        return root(form[w]) if w in form else w

    return {(w, form.get(w), root(w), n[w], len(near[w]), n.get(form.get(w))) for w in n}


def invented(rng, letters, words, rows):
    base = ["".join(rng.choice(list(letters), rng.integers(4, 10))) for _ in range(words)]
    for w in base[: words // 3]:
        i = int(rng.integers(0, len(w)))
        base += [w[:i] + w[i + 1 :], w[:i] + rng.choice(list(letters)) + w[i:], w[:i] + rng.choice(list(letters)) + w[i + 1 :]]
    weight = rng.pareto(0.5, len(base)) + 0.2
    return [(i, " ".join(rng.choice(base, 60, p=weight / weight.sum())).title() + " été-Œ naïve_x") for i in range(rows)]


@pytest.mark.parametrize("cell_words,sample", [(8000, 200_000), (40, 200_000), (30, 200)])
def test_forms_equal_brute_force(spark, cell_words, sample):
    rng = np.random.default_rng(7)
    rows = invented(rng, "abcdéñ", 400, 150) + [(None, "straße Straße " * 9), (900, None), (901, ""), (901, "abcabc " * 3), (901, "abcabc " * 3)]
    rows += [(2000 + i, "planted " * 5) for i in range(60)] + [(3000 + i, "plantedx " * 5) for i in range(10)] + [(4000 + i, "plantedxy ") for i in range(8)]
    df = spark.createDataFrame([(k, t, "w", 1) for k, t in rows], "doc_id long, text string, word string, n int").repartition(4)
    got = [tuple(r) for r in spelling.spelling_forms(df, shortest=3, least=3, period=7, cell_words=cell_words, sample=sample).collect()]
    want = brute_forms(rows, 3, 3, 7)
    assert set(got) == want and len(got) == len(want)
    assert any(r[1] and r[2] != r[1] for r in want)  # chains of several forms


def test_words_of_the_same_letters(spark):
    """Words that letter counts of the whole word cannot tell apart are cut by those of the first half."""
    rng = np.random.default_rng(3)
    words = sorted({"".join(rng.permutation(list("aaabbbccc"))) for _ in range(600)})
    other = [w[:4] + "d" + w[5:] for w in words[:50]]
    df = spark.createDataFrame([(1, " ".join((words + other) * 5))], "doc_id long, text string")
    got = {tuple(r) for r in spelling.spelling_forms(df, period=10**12, cell_words=50).collect()}
    assert got == brute_forms([(1, " ".join((words + other) * 5))], period=10**12)
    tree = spelling.grow(spelling.letter_counts(spelling.letter_codes(words, 9), 4), np.arange(len(words)), 50)
    assert isinstance(tree, tuple)


def test_long_words_and_no_words(spark):
    long = "ab" * 5000
    rows = [(1, " ".join([long] * 30 + [long + "c"] * 5 + [long[1:]] * 6))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {tuple(r) for r in spelling.spelling_forms(df).collect()} == brute_forms(rows)
    assert spelling.spelling_forms(df.filter("doc_id > 5")).count() == 0
    assert spelling.spelling_forms(spark.createDataFrame([(1, "12 , ."), (2, None)], df.schema)).count() == 0
