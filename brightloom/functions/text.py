"""Token expressions over whole texts. All are column expressions: no shuffle, no Python per row."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Common English function words removed before counting terms.
STOP_WORDS = (
    "a about after all also am an and any are as at be because been before being but by can could did do does "
    "doing down during each few for from further had has have having he her here hers him his how i if in into is "
    "it its just me more most my no nor not now of off on once only or other our out over own same she should so "
    "some such than that the their them then there these they this those through to too under until up very was "
    "we were what when where which while who whom why will with would you your"
).split()

# Small polarity word table used when the caller brings none.
POLARITY = {
    "good": 1.0, "great": 1.0, "excellent": 1.0, "love": 1.0, "happy": 1.0, "helpful": 1.0, "easy": 1.0, "fast": 1.0, "perfect": 1.0,
    "recommend": 1.0, "bad": -1.0, "poor": -1.0, "terrible": -1.0, "hate": -1.0, "broken": -1.0, "slow": -1.0, "difficult": -1.0,
    "disappointed": -1.0, "expensive": -1.0, "waste": -1.0,
}


def letters_only(c: Column | str) -> Column:
    """Lower case, every character outside a-z and white space dropped (other alphabets are not folded)."""
    return F.regexp_replace(F.lower(F.col(c) if isinstance(c, str) else c), r"[^a-z\s]", "")


def tokens(c: Column | str, stop_words: Iterable[str] = STOP_WORDS, min_length: int = 1) -> Column:
    """Ordered tokens with repeats; stop words are looked up in a hash set."""
    stop = list(stop_words)

    def keep(t: Column) -> Column:
        ok = F.length(t) >= min_length
        return ok & ~t.isin(*stop) if stop else ok

    return F.filter(F.split(letters_only(c), r"\s+"), keep)


def one_of(words: Iterable[str]) -> Callable[[Column], Column]:
    """Predicate for array functions: the token is one of ``words`` (a hash-set lookup)."""
    fixed = list(words)
    return lambda t: t.isin(*fixed)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once: an expression written twice inside a lambda is evaluated each time."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def polarity_sum(toks: Column, lexicon: Mapping[str, float]) -> Column:
    """Sum of the word weights of a token array in one pass; words of equal weight share one hash set."""
    by_weight: dict[float, list[str]] = {}
    for word, weight in lexicon.items():
        by_weight.setdefault(float(weight), []).append(word)

    def weight_of(t: Column) -> Column:
        w = F.lit(0.0)
        for weight, words in by_weight.items():
            w = F.when(t.isin(*words), F.lit(weight)).otherwise(w)
        return w

    return F.aggregate(toks, F.lit(0.0), lambda total, t: total + weight_of(t))


def term_counts(toks: Column) -> Column:
    """Array of ``(term, tf)``, one entry per distinct token: run lengths of the sorted tokens, without a shuffle."""

    def runs(s: Column) -> Column:
        n = F.size(s)
        starts = F.filter(F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>")), lambda i: (i == 0) | (F.get(s, i) != F.get(s, i - 1)))
        return let(starts, lambda at: F.transform(at, lambda i, k: F.struct(F.get(s, i).alias("term"), (F.coalesce(F.get(at, k + 1), n) - i).alias("tf"))))

    return let(F.array_sort(F.coalesce(toks, F.array().cast("array<string>"))), runs)


def ngrams(toks: Column, n: int, stop_words: Iterable[str] = ()) -> Column:
    """Blank-joined n-grams of a token array that neither start nor end with a stop word."""
    stop = list(stop_words)
    starts = F.when(F.size(toks) >= n, F.sequence(F.lit(1), F.size(toks) - (n - 1)))
    starts = F.coalesce(starts, F.array().cast("array<int>"))
    if stop:
        starts = F.filter(starts, lambda i: ~F.get(toks, i - 1).isin(*stop) & ~F.get(toks, i + (n - 2)).isin(*stop))
    return F.transform(starts, lambda i: F.concat_ws(" ", *[F.get(toks, i + (j - 1)) for j in range(n)]))


def sentences(c: Column | str) -> Column:
    """Trimmed non-empty sentences, split after . ! ? or at line ends."""
    parts = F.split(F.col(c) if isinstance(c, str) else c, r"[.!?]+\s*|\n+")
    return F.filter(F.transform(parts, lambda s: F.trim(s)), lambda s: s != "")
