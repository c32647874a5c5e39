"""Quality rules: exact counting rules, then a linear-chain conditional random field over the lines of a text.

The field marks every line as content or boilerplate (Viterbi path over the whole text); the share of words in
content lines decides whether a document stays.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brightloom.llm.common import SPACE_BYTES, hash_share, lbfgs, small_batches

SYMBOLS = b"#*$%&|<>"
_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))
_DIGITS = b"0123456789"

# Line features are one-hot groups: a value falls into the step given by the limits of its group.
_STEPS = (
    ("words", (3, 8, 20, 60)),
    ("symbols per word", (0.02, 0.1, 0.3)),
    ("capitals per ASCII letter", (0.1, 0.3, 0.6)),
    ("digits per character", (0.05, 0.2)),
    ("distinct words per word", (0.3, 0.5, 0.7, 0.9)),
    ("exclamation marks per word", (0.05, 0.3)),
    ("characters per word", (3.0, 4.5, 7.0, 12.0)),
)
_OFFSETS = np.cumsum([0, *[len(s) + 1 for _, s in _STEPS]])
#: After the groups: ends like a sentence, repeats an earlier line, always on.
N_FEATURES = int(_OFFSETS[-1]) + 3


@dataclass(frozen=True)
class LineModel:
    emit: np.ndarray  # (2, N_FEATURES): boilerplate, content
    move: np.ndarray  # (2, 2)


def _without(b: bytes, chars: bytes) -> int:
    return len(b) - len(b.translate(None, chars))


def line_features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers (lines x groups+3, ``N_FEATURES`` where off) and word counts of all lines with a word."""
    rows, sizes, seen = [], [], set()
    for line in text.encode("utf-8", "replace").split(b"\n"):
        words = line.split()
        if not words:
            continue
        n = len(words)
        capitals = _without(line, _UPPER)
        values = (n, _without(line, SYMBOLS) / n, capitals / max(1, capitals + _without(line, _LOWER)), _without(line, _DIGITS) / len(line), len(set(words)) / n, line.count(b"!") / n, sum(map(len, words)) / n)
        row = [int(o) + sum(v >= x for x in limits) for (_, limits), o, v in zip(_STEPS, _OFFSETS, values)]
        row.append(int(_OFFSETS[-1]) if words[-1][-1:] in b".?:;" else N_FEATURES)
        row.append(int(_OFFSETS[-1]) + 1 if line in seen else N_FEATURES)
        row.append(N_FEATURES - 1)
        seen.add(line)
        rows.append(row)
        sizes.append(n)
    return np.array(rows, np.int16).reshape(len(rows), len(_STEPS) + 3), np.array(sizes, np.int64)


def viterbi(scores: np.ndarray, move: np.ndarray) -> np.ndarray:
    """Best label sequence for line scores (lines x 2); ties go to content."""
    n = len(scores)
    back = np.zeros((n, 2), np.int8)
    a, b = scores[0] if n else (0.0, 0.0)
    (m00, m01), (m10, m11) = move.tolist()
    for i in range(1, n):
        s0, s1 = scores[i]
        to0, to1 = (a + m00, b + m10), (a + m01, b + m11)
        back[i] = (to0[1] >= to0[0], to1[1] >= to1[0])
        a, b = max(to0) + s0, max(to1) + s1
    path = np.zeros(n, np.int8)
    if n:
        path[-1] = b >= a
        for i in range(n - 1, 0, -1):
            path[i - 1] = back[i, path[i]]
    return path


def _fit(sequences: Sequence[np.ndarray], labels: Sequence[np.ndarray | int], ridge: float) -> LineModel:
    """Maximum conditional likelihood of line labels; all sequences advance together, one line position at a time."""
    order = sorted(range(len(sequences)), key=lambda i: -len(sequences[i]))
    seqs = [sequences[i] for i in order]
    ys = [np.broadcast_to(np.asarray(labels[i], int), len(sequences[i])) for i in order]
    lengths = np.array([len(s) for s in seqs])
    width = seqs[0].shape[1]
    longest = int(lengths[0])
    at = np.full((len(seqs), longest, width), N_FEATURES, np.int16)
    for i, s in enumerate(seqs):
        at[i, : len(s)] = s
    alive = [int((lengths > t).sum()) for t in range(longest)]
    lines, of_line = np.concatenate(seqs), np.concatenate(ys)
    seen = np.stack([np.bincount(lines[of_line == label].ravel(), minlength=N_FEATURES + 1) for label in (0, 1)]).astype(float)
    moved = np.zeros((2, 2))
    for y in ys:
        np.add.at(moved, (y[:-1], y[1:]), 1)

    def loss(x: np.ndarray) -> tuple[float, np.ndarray]:
        emit = np.hstack([x[: 2 * N_FEATURES].reshape(2, N_FEATURES), np.zeros((2, 1))])
        move = x[2 * N_FEATURES :].reshape(2, 2)
        score = emit[:, at].sum(-1)  # 2 x sequences x positions
        fwd, bwd = np.zeros_like(score), np.zeros_like(score)
        fwd[:, :, 0] = score[:, :, 0]
        for t in range(1, longest):
            k = alive[t]
            fwd[:, :k, t] = np.logaddexp(fwd[0, :k, t - 1] + move[0][:, None], fwd[1, :k, t - 1] + move[1][:, None]) + score[:, :k, t]
        pair = np.zeros((2, 2))
        ends = np.arange(len(seqs)), lengths - 1
        log_z = np.logaddexp(fwd[0][ends], fwd[1][ends])
        for t in range(longest - 1, 0, -1):
            k = alive[t]
            ahead = score[:, :k, t] + bwd[:, :k, t]
            bwd[:, :k, t - 1] = np.logaddexp(ahead[0] + move[:, 0][:, None], ahead[1] + move[:, 1][:, None])
            for i in (0, 1):
                for j in (0, 1):
                    pair[i, j] += np.exp(fwd[i, :k, t - 1] + move[i, j] + ahead[j] - log_z[:k]).sum()
        inside = np.arange(longest)[None] < lengths[:, None]
        p = np.where(inside, np.exp(fwd + bwd - log_z[None, :, None]), 0.0)
        expected = np.stack([np.bincount(at.ravel(), np.repeat(p[j].ravel(), width), N_FEATURES + 1) for j in (0, 1)])
        gold = (emit * seen).sum() + (move * moved).sum()
        g = np.r_[(expected - seen)[:, :N_FEATURES].ravel(), (pair - moved).ravel()]
        scale = 1.0 / lengths.sum()
        return float(scale * (log_z.sum() - gold) + ridge * (x @ x)), scale * g + 2 * ridge * x

    x = lbfgs(loss, np.zeros(2 * N_FEATURES + 4))
    return LineModel(x[: 2 * N_FEATURES].reshape(2, N_FEATURES), x[2 * N_FEATURES :].reshape(2, 2))


def joined(pieces: Sequence[np.ndarray], labels: Sequence[np.ndarray], quality: Sequence[int], run: float, rng: np.random.Generator) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Sequences that take turns between a piece of a good and one of a bad text, and the pieces without a partner as they are.

    Runs of the shorter piece have about ``run`` lines, those of the longer one are longer in proportion, so that both end together.
    """
    sides = [rng.permutation([i for i, q in enumerate(quality) if q == side]) for side in (0, 1)]
    out: tuple[list[np.ndarray], list[np.ndarray]] = ([], [])
    for pair in zip(*sides):
        sizes = [len(pieces[i]) for i in pair]
        at, turn = [0, 0], int(rng.integers(0, 2))
        rows, marks = [], []
        while at[0] < sizes[0] or at[1] < sizes[1]:
            i = pair[turn]
            n = int(rng.geometric(min(1.0, min(sizes) / (run * sizes[turn])))) if at[1 - turn] < sizes[1 - turn] else sizes[turn]
            rows.append(pieces[i][at[turn] : at[turn] + n])
            marks.append(labels[i][at[turn] : at[turn] + n])
            at[turn] += n
            turn = 1 - turn
        out[0].append(np.concatenate(rows))
        out[1].append(np.concatenate(marks))
    both = min(map(len, sides))
    for i in [*sides[0][both:], *sides[1][both:]]:
        out[0].append(pieces[i])
        out[1].append(labels[i])
    return out


def fit_latent(pieces: Sequence[np.ndarray], quality: Sequence[int], ridge: float = 1e-4, rounds: int = 2, run: float = 1.5, prior: float = 3.0) -> LineModel:
    """Fit with line labels that are not given: only the quality of the text of each piece is.

    Lines first carry the label of their text. Every round fits the field on pieces joined in pairs, where labels switch, and
    then labels the lines of each piece anew by their best path, with ``prior`` in favour of the text's label;
    so a junk line of a good text, and a sentence of a bad one, change sides before the next fit.
    """
    rng = np.random.default_rng(31)
    labels = [np.full(len(p), q) for p, q in zip(pieces, quality)]
    for left in range(rounds, 0, -1):
        model = _fit(*joined(pieces, labels, quality, run, rng), ridge)
        if left > 1:
            emit = np.hstack([model.emit, np.zeros((2, 1))])
            labels = [viterbi(emit[:, p].sum(-1).T + prior * np.eye(2)[q], model.move) for p, q in zip(pieces, quality)]
    return model


def train(
    docs: DataFrame, labels: DataFrame, per_class: int = 2000, piece: int = 48, pieces: int = 8, ridge: float = 1e-4, text: str = "text", key: str = "doc_id", quality: str = "quality"
) -> LineModel | None:
    """Fit on a sample of about ``per_class`` labelled texts of either quality (hash of the key; all where fewer).

    Texts are cut into pieces of ``piece`` lines; of a text with more than ``pieces`` of them, as many are taken evenly
    from its whole length, so the driver gets a bounded number of line rows. Without rows of both classes there is no model (None).
    """
    marked = labels.select(F.col(key).alias("k"), F.col(quality).alias("y")).filter("k IS NOT NULL AND y IN (0, 1)").groupBy("k").agg(F.max("y").alias("y"))
    totals = {r["y"]: r["n"] for r in marked.groupBy("y").agg(F.expr("count(1) AS n")).collect()}
    if len(totals) < 2:
        return None
    rate = F.when(F.col("y") == 0, min(1.0, per_class / totals[0])).otherwise(min(1.0, per_class / totals[1]))
    drawn = marked.filter(hash_share(23, "k") < rate)  # about 2 * per_class keys
    sample = docs.select(F.col(key).alias("k"), F.col(text).alias("text")).join(F.broadcast(drawn), "k").select("k", "text", "y")

    def extract(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for k, t, y in zip(f["k"], f["text"], f["y"]):
                lines = line_features(t or "")[0]
                cuts = range(0, len(lines), piece)
                for i in sorted({cuts[j * len(cuts) // min(pieces, len(cuts))] for j in range(min(pieces, len(cuts)))}):
                    rows.append((k, i, int(y), lines[i : i + piece].ravel().tolist()))
            if rows:
                yield pd.DataFrame(rows, columns=["k", "i", "y", "lines"])

    got = sample.mapInPandas(extract, "k long, i long, y int, lines array<short>").toPandas().sort_values(["k", "i", "lines"], key=lambda c: c if c.name != "lines" else c.map(tuple))
    if got["y"].nunique() < 2:
        return None
    return fit_latent([np.asarray(x, np.int16).reshape(-1, len(_STEPS) + 3) for x in got["lines"]], got["y"].tolist(), ridge)


def base_counts(text: str) -> tuple[int, int, int, int, int]:
    """Words, their code points, symbols, repeated lines, and words in three-word windows that occur twice or more."""
    b = text.encode("utf-8", "replace")
    words = b.split()
    n = len(words)
    chars = len(text) - _without(b, SPACE_BYTES)
    symbols = _without(b, SYMBOLS)
    lines = [x for x in b.split(b"\n") if x.strip()]
    repeated = 0
    if n >= 4:
        number: dict[bytes, int] = {}
        ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
        size = len(number)
        pairs = ids[:-1] * size + ids[1:]
        if size > 1_000_000:  # keeps the product of three numbers within 64 bits
            pairs = np.unique(pairs, return_inverse=True)[1]
        windows = pairs[:-1] * size + ids[2:]
        order = np.sort(windows)
        if (order[1:] == order[:-1]).any():
            _, inverse, count = np.unique(windows, return_inverse=True, return_counts=True)
            hit = count[inverse] > 1
            covered = np.zeros(n, bool)
            for shift in range(3):
                covered[shift : shift + n - 2] |= hit
            repeated = int(covered.sum())
    return n, chars, symbols, len(lines) - len(set(lines)), repeated


def content_share(text: str, model: LineModel | None) -> float:
    """Share of words in lines that the best path marks as content (1 without lines or model)."""
    if model is None:
        return 1.0
    at, sizes = line_features(text)
    if not len(sizes):
        return 1.0
    emit = np.hstack([model.emit, np.zeros((2, 1))])
    path = viterbi(emit[:, at].sum(-1).T, model.move)
    return float((sizes * path).sum() / sizes.sum())


def quality_of(df: DataFrame, model: LineModel | None, text: str = "text") -> Column:
    """Struct column of the counts and the content share of a text column (null text: no words)."""
    parts = None if model is None else (model.emit, model.move)
    held = small_batches(df).sparkSession.sparkContext.broadcast(parts)

    @F.pandas_udf("struct<n_words:long,word_chars:long,n_symbols:long,n_dup_lines:long,n_repeat_words:long,content_share:double>")
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = None if held.value is None else LineModel(*held.value)
        for s in batches:
            texts = [t if isinstance(t, str) else "" for t in s]
            out = pd.DataFrame([base_counts(t) for t in texts], columns=["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"])
            yield out.assign(content_share=[content_share(t, own) for t in texts])

    return judge.asNondeterministic()(F.col(text))


def judge_documents(docs: DataFrame, labels: DataFrame, min_words: int = 50, max_repeat_percent: int = 50, min_content: float = 0.5, **params) -> DataFrame:
    """Counts and verdict of every row: ``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, content_share, kept``.

    ``base_failed``: fewer than ``min_words`` words, or more than ``max_repeat_percent`` percent of the words in
    repeated windows. ``kept``: not failed and at least ``min_content`` of the words in content lines. Null and
    empty texts have no words and fail; repeated rows get equal results; other columns are not looked at.
    """
    model = train(docs, labels, **params)
    q = docs.select("doc_id", quality_of(docs, model).alias("q")).select("doc_id", "q.*")
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words"))
    return q.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & (F.col("content_share") >= min_content))
