"""Quality rules: base counts of words, lines and repeats, and perplexity bands of a modified Kneser-Ney model.

The model is of whole characters, whatever their number and script: Spark counts the trigrams of all documents, discounts and
smooths the three orders by joins, and stores the bits of every trigram that occurs, a table as large as the corpus makes
it. The lowest order falls back on the spelling of a character in 64 symbols, of which a language's most frequent characters
have one of their own. Trigrams of these are looked up by number, all others in sorted arrays; the most frequent trigrams are
known to all tasks, those beyond KNOWN are joined. Bits are whole millionths, so sums don't depend on their order.

trigram_codes, kneser_ney and log2_probabilities are the same model of spelled texts, in memory.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assaylake.llm.encoding import steps
from assaylake.llm.hashing import spread
from assaylake.llm.rows import unwrap, wrap
from assaylake.session import forget, settle

SYMBOLS, ORDER = 64, 3
CODES = SYMBOLS**ORDER
#: Characters with a symbol of their own; code points that there are; symbols that follow each first one.
OWN, POINTS = 59, 0x110000
PLAIN = np.frombuffer(b" abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ.,'-\n0", np.uint8).astype(np.int64)
_MORE = np.array([0] * 60 + [1, 1, 2, 4], np.uint8)
#: Bits of a character in a gram: its code point and one, or 0 before a text. A trigram takes 63.
WIDTH = 21
PLACE = (1 << WIDTH) - 1
#: At most so many trigrams are known to all tasks (12 bytes each). All others are joined by a shuffle, with the same result.
KNOWN = 1 << 20
#: Parts of a bit in which values are kept.
UNIT = 1_000_000
#: A language has a model and bands of its own if it has at least this share of the documents, so there are at most 64;
#: all others share one.
LANGUAGE_SHARE = 1 / 64
POOLED = "other"
#: The bands reach from the median as many median absolute deviations (six are four standard deviations of a normal
#: spread), and at least this share of the median's bits. Both are of distinct texts that pass the base rules; a third of
#: them being junk moves the median within the good texts' quartiles.
REACH, LEAST_REACH = 6.0, 0.2
#: Base rules: fewest words, and the largest percentage of words in repeats.
LEAST_WORDS, MOST_REPEATED = 10, 20
#: The mean over few words strays further: bits that a band is widened by, over the root of the number of words.
SHORT_REACH = 18.0
STEP_BYTES = 2 << 20


def _symbols(alphabet: np.ndarray) -> np.ndarray:
    """First symbol of every code point: 0 stands before a text, 1-59 are the alphabet's; 60 and 61 begin other ASCII signs
    (one more symbol), 62 code points below 0x1000 (two more), 63 all others (four more)."""
    out = np.full(POINTS, 63, np.uint8)
    out[:0x1000] = 62
    out[:0x80] = 60 + (np.arange(0x80) >> 6)
    out[alphabet[:OWN]] = np.arange(1, min(len(alphabet), OWN) + 1)
    return out


def spellings(alphabets: list[np.ndarray]) -> np.ndarray:
    """The first symbols by several alphabets, one after the other."""
    return np.concatenate([_symbols(a) for a in alphabets])


_TABLE: list[np.ndarray] = []


def _points(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the texts one after the other, and how many each has."""
    lengths = pc.utf8_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    return np.frombuffer("".join(texts.to_pylist()).encode("utf-32-le"), "<u4"), lengths


def _spell(points: np.ndarray, lengths: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All symbols of the texts whose code points begin with the symbols `first`, and how many each text has."""
    more = _MORE[first]
    if not more.any():
        return first, lengths
    ends = np.cumsum(more + np.int64(1))
    out = np.zeros(int(ends[-1]), np.uint8)
    out[ends - more - 1] = first
    for k in range(int(more.max())):  # the last symbols are the lowest six bits, and so on
        there = more > k
        out[ends[there] - 1 - k] = (points[there] >> (6 * k)) & 63
    upto = np.concatenate([[0], ends])
    last = np.cumsum(lengths)
    return out, upto[last] - upto[last - lengths]


def trigram_codes(texts: pa.Array, tables: np.ndarray | None = None, which: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Trigram code of every symbol of the texts one after the other, and the number of symbols of each. Texts are spelled
    by the alphabet that `which` names in the tables, or by the plain one."""
    if tables is None:
        if not _TABLE:
            _TABLE.append(_symbols(PLAIN))
        tables, which = _TABLE[0], np.zeros(len(texts), np.int64)
    points, lengths = _points(texts)
    symbols, lengths = _spell(points, lengths, tables[points + np.repeat(which * POINTS, lengths)])
    return _codes(symbols, lengths), lengths


def _codes(symbols: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Number of every symbol and the two before it in its text."""
    ends = np.cumsum(lengths + 2)
    padded = np.zeros(int(ends[-1]) if len(ends) else 0, np.int32)
    inside = np.ones(len(padded), bool)
    begin = ends - lengths - 2
    inside[begin] = inside[begin + 1] = False
    padded[inside] = symbols
    codes = np.zeros(len(padded), np.int32)
    codes[2:] = padded[:-2] * SYMBOLS**2 + padded[1:-1] * SYMBOLS + padded[2:]
    return codes[inside]


def _windows(texts: pa.Array, tables: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Code points of the texts, how many each has, the number of every character and the two before it by their first
    symbols, and the places of those among which one has no symbol of its own, so that the number doesn't tell them."""
    points, lengths = _points(texts)
    first = tables[points + np.repeat(which * POINTS, lengths)]
    odd = np.flatnonzero(first > OWN)
    ends = np.cumsum(lengths)
    last = ends[np.searchsorted(ends, odd, side="right")]
    far = np.unique(np.concatenate([odd, *((odd + k)[odd + k < last] for k in (1, 2))]))
    return points, lengths, _codes(first, lengths), far


def _grams(points: np.ndarray, lengths: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Trigrams that end at these places, and the text of each."""
    ends = np.cumsum(lengths)
    text = np.searchsorted(ends, at, side="right")
    begin = (ends - lengths)[text]
    grams = np.zeros(len(at), np.int64)
    for back in (2, 1, 0):
        character = np.where(at - back >= begin, points[np.maximum(at - back, 0)].astype(np.int64) + 1, 0)
        grams = grams << WIDTH | character
    return grams, text


def _by_letters(codes: np.ndarray, letters: list[np.ndarray]) -> np.ndarray:
    """Trigrams of the numbers of characters with symbols of their own; the numbers of a language follow those of another."""
    characters = np.zeros((len(letters), SYMBOLS), np.int64)
    for k, alphabet in enumerate(letters):
        characters[k, 1 : len(alphabet[:OWN]) + 1] = alphabet[:OWN] + 1
    which, grams = codes // CODES, np.zeros(len(codes), np.int64)
    for power in (2, 1, 0):
        grams = grams << WIDTH | characters[which, codes // SYMBOLS**power % SYMBOLS]
    return grams


def _by_number(which: np.ndarray, grams: np.ndarray, tables: np.ndarray) -> np.ndarray:
    """The inverse: numbers of trigrams, or -1 where a character has no symbol of its own."""
    codes, own = which * 1, np.ones(len(grams), bool)
    for shift in (2 * WIDTH, WIDTH, 0):
        character = grams >> shift & PLACE
        symbol = np.where(character > 0, tables[which * POINTS + np.maximum(character - 1, 0)], 0).astype(np.int64)
        own &= symbol <= OWN
        codes = codes * SYMBOLS + symbol
    return np.where(own, codes, -1)


def _hash(codes: np.ndarray, order: int) -> np.ndarray:
    """A one-to-one mix of n-gram codes, apart for each order."""
    x = codes.astype(np.uint64) + np.uint64((order << 60) + 0x9E3779B97F4A7C15 % (1 << 60))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


def _discounts(counts: np.ndarray) -> np.ndarray:
    """The three discounts of an order from its counts."""
    return _discounts_of([int((counts == k).sum()) for k in range(5)])


def _discounts_of(n: list[int]) -> np.ndarray:
    """The three discounts from how many n-grams occur once to four times; absent ones take 1/2, 1, 3/2."""
    if not all(n[1:]):
        return np.array([0.0, 0.5, 1.0, 1.5])
    y = n[1] / (n[1] + 2 * n[2])
    found = [0.0, *(k - (k + 1) * y * n[k + 1] / n[k] for k in (1, 2, 3))]
    return np.clip(found, [0, 0.05, 0.05, 0.05], [0, 1, 2, 3])


@dataclass(frozen=True)
class HashedOrder:
    """One order as sorted hashes: value of an n-gram's discounted share, and of a context's back-off weight."""

    grams: np.ndarray
    shares: np.ndarray
    contexts: np.ndarray
    weights: np.ndarray


def _order(codes: np.ndarray, counts: np.ndarray, order: int) -> HashedOrder:
    d = _discounts(counts)
    contexts, which = np.unique(codes // SYMBOLS, return_inverse=True)
    totals = np.bincount(which, counts)
    kept = counts - d[np.minimum(counts, 3)]
    freed = 1 - np.bincount(which, kept) / totals
    grams, places = _hash(codes, order), _hash(contexts, order)
    a, b = np.argsort(grams), np.argsort(places)
    return HashedOrder(grams[a], (kept / totals[which])[a], places[b], freed[b])


def _find(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray, absent: float) -> np.ndarray:
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], absent)


def kneser_ney(codes: np.ndarray, counts: np.ndarray) -> list[HashedOrder]:
    """Orders 1 to 3 of a modified Kneser-Ney model from trigram counts; lower orders count different contexts."""
    two, n_two = np.unique(codes % SYMBOLS**2, return_counts=True)
    one, n_one = np.unique(two % SYMBOLS, return_counts=True)
    return [_order(one, n_one, 1), _order(two, n_two, 2), _order(codes, counts, 3)]


def log2_probabilities(model: list[HashedOrder], codes: np.ndarray) -> np.ndarray:
    """Log-probability of each trigram's last symbol after the two before it."""
    p = np.full(len(codes), 1 / SYMBOLS)
    for order, table in enumerate(model, start=1):
        gram = codes % SYMBOLS**order
        share = _find(table.grams, table.shares, _hash(gram, order), 0.0)
        weight = _find(table.contexts, table.weights, _hash(gram // SYMBOLS, order), 1.0)
        p = share + weight * p
    return np.log2(p)


def _language(frame_language: Column, own: list[str]) -> Column:
    return F.when(frame_language.isin(own), frame_language).otherwise(F.lit(POOLED)) if own else F.lit(POOLED)


def _characters(languages: list[str]):
    def characters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = pa.array(languages)
        for batch in batches:
            texts = pc.fill_null(batch.column("text"), "")
            which = pc.index_in(batch.column("language"), names).to_numpy(zero_copy_only=False).astype(np.int64)
            for at, n in steps(texts, STEP_BYTES):
                points, lengths = _points(texts.slice(at, n))
                found, times = np.unique(points + np.repeat(which[at : at + n] * POINTS, lengths), return_counts=True)
                yield pa.RecordBatch.from_pydict(
                    {"language": names.take(pa.array(found // POINTS)), "point": pa.array(found % POINTS), "n": pa.array(times)}
                )

    return characters


def alphabets(docs: DataFrame, languages: list[str]) -> list[np.ndarray]:
    """The most frequent code points of each language in the rows (language, text), OWN at most."""
    counted = docs.select("text", "language").mapInArrow(_characters(languages), "language string, point bigint, n bigint")
    order = Window.partitionBy("language").orderBy(F.desc("n"), "point")
    ranked = counted.groupBy("language", "point").agg(F.sum("n").alias("n")).withColumn("place", F.row_number().over(order))
    rows = ranked.where(F.col("place") <= OWN).orderBy("language", "place").collect()
    return [np.array([r["point"] for r in rows if r["language"] == name], np.int64) for name in languages]


def _count(languages: list[str], letters: list[np.ndarray]):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(len(languages) * CODES, np.int64)
        there = np.zeros(len(counts), bool)
        names, tables = pa.array(languages), spellings(letters)
        for batch in batches:
            texts = pc.fill_null(batch.column("text"), "")
            every = pc.index_in(batch.column("language"), names).to_numpy(zero_copy_only=False).astype(np.int64)
            for at, n in steps(texts, STEP_BYTES):
                part, which = texts.slice(at, n), every[at : at + n]
                base = base_counts(part)
                good = (base["n_words"] >= LEAST_WORDS) & (100 * base["n_repeat_words"] <= MOST_REPEATED * base["n_words"])
                points, lengths, codes, far = _windows(part, tables, which)
                trained = np.repeat(good, lengths)
                if len(far):
                    grams, text = _grams(points, lengths, far)
                    yield _tally(which[text], grams, trained[far])
                near = np.ones(len(codes), bool)
                near[far] = False
                codes = codes + np.repeat(which * CODES, lengths)
                counts += np.bincount(codes[near & trained], minlength=len(counts))
                there[codes[near & ~trained]] = True
        found = np.flatnonzero(there | (counts > 0))
        yield pa.RecordBatch.from_arrays(
            [pa.array((found // CODES).astype(np.int32)), pa.array(_by_letters(found, letters)), pa.array(counts[found])], ["which", "gram", "n"]
        )

    return count


def _tally(which: np.ndarray, grams: np.ndarray, counted: np.ndarray) -> pa.RecordBatch:
    """Distinct grams of every language, and how many of each are counted."""
    order = np.lexsort((grams, which))
    which, grams = which[order], grams[order]
    first = np.flatnonzero(np.concatenate([[True], (grams[1:] != grams[:-1]) | (which[1:] != which[:-1])]))
    n = np.add.reduceat(counted[order], first, dtype=np.int64)
    return pa.RecordBatch.from_arrays([pa.array(which[first].astype(np.int32)), pa.array(grams[first]), pa.array(n)], ["which", "gram", "n"])


def own_languages(docs: DataFrame, language: str) -> list[str]:
    """Languages with a share of their own, at most 1 / LANGUAGE_SHARE, so that what the driver gets is bounded."""
    tally = docs.groupBy(F.col(language).cast("string").alias("language")).agg(F.count(F.lit(1)).alias("n"))
    total = docs.count()
    rows = tally.where(F.col("language").isNotNull() & (F.col("n") >= math.ceil(total * LANGUAGE_SHARE))).collect()
    return sorted(r["language"] for r in rows)


def _bases(letters: list[np.ndarray]):
    """Beside every character what its spelling alone makes of it: each of its symbols is one of 64."""

    def bases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = spellings(letters)
        for batch in batches:
            which, gram = (batch.column(c).to_numpy().astype(np.int64) for c in ("which", "gram"))
            base = float(SYMBOLS) ** -(1.0 + _MORE[tables[which * POINTS + gram - 1]])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(base)], [*batch.schema.names, "base"])

    return bases


def _shares(table: DataFrame, n_languages: int) -> DataFrame:
    """The grams of an order (which, gram, n) with the discounted share that each has among those of its context, and the
    weight that the context leaves to the lower order."""
    found = [[0] * 5 for _ in range(n_languages)]
    for r in table.where(F.col("n").between(1, 4)).groupBy("which", "n").agg(F.count(F.lit(1)).alias("grams")).collect():
        found[r["which"]][r["n"]] = r["grams"]
    cuts = F.array(*[F.lit(float(d)) for n in found for d in _discounts_of(n)])
    cut = lambda n: F.get(cuts, (F.col("which") * 4 + n).cast("int"))
    n, context = F.col("n"), F.shiftright("gram", WIDTH).alias("context")
    times = [F.count_if(n == 1), F.count_if(n == 2), F.count_if(n > 2)]
    contexts = table.groupBy("which", context).agg(F.sum("n").alias("total"), *[t.alias(f"n{k}") for k, t in enumerate(times, 1)])
    freed = sum(F.col(f"n{k}") * cut(k) for k in (1, 2, 3))
    seen = F.col("total") > 0
    share = F.when(seen, (n - cut(F.least(n, F.lit(3)))) / F.col("total")).otherwise(0.0)
    weight = F.when(seen, freed / F.col("total")).otherwise(1.0)
    return table.withColumn("context", context).join(contexts, ["which", "context"]).select(*table.columns, share.alias("share"), weight.alias("weight"))


def train(docs: DataFrame, languages: list[str], letters: list[np.ndarray]) -> DataFrame:
    """The bits of every trigram in the rows of docs (language, text) by the model of its language: which (the language's
    place), gram, n and bits in millionths. Models are of the rows that pass the base rules, in which the gram is n times."""
    counted = docs.mapInArrow(_count(languages, letters), "which int, gram bigint, n bigint")
    orders = [settle(counted.groupBy("which", "gram").agg(F.sum("n").alias("n")), "trigrams")]
    for order in (2, 1):  # lower orders count different contexts
        gram = F.col("gram").bitwiseAND((1 << order * WIDTH) - 1).alias("gram")
        lower = orders[0].groupBy("which", gram).agg(F.count_if(F.col("n") > 0).alias("n"))
        if order == 1:
            lower = lower.mapInArrow(_bases(letters), "which int, gram bigint, n bigint, base double")
        orders.insert(0, settle(lower, "lower-order"))
    model = _shares(orders[0], len(languages)).withColumn("p", F.col("share") + F.col("weight") * F.col("base"))
    for order, table in enumerate(orders[1:], start=1):
        lower = model.select(F.col("which").alias("of"), F.col("gram").alias("end"), F.col("p").alias("below"))
        end = F.col("gram").bitwiseAND((1 << order * WIDTH) - 1)
        joined = _shares(table, len(languages)).join(lower, (F.col("which") == F.col("of")) & (end == F.col("end")))
        model = joined.withColumn("p", F.col("share") + F.col("weight") * F.col("below"))
    values = settle(model.select("which", "gram", "n", F.round(-F.log2("p") * UNIT).cast("int").alias("bits")), "trigram-bits")
    for table in orders:
        forget(table)
    return values


def _known(values: pa.Table, letters: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """Numbers and bits of the trigrams that have a number; of each language, the sorted other trigrams and their bits."""
    which, grams, bits = (values.column(c).to_numpy() for c in ("which", "gram", "bits"))
    codes = _by_number(which.astype(np.int64), grams, spellings(letters))
    near, others = codes >= 0, []
    for k in range(len(letters)):
        of = np.flatnonzero(~near & (which == k))
        of = of[np.argsort(grams[of])]
        others.append((grams[of], bits[of]))
    return codes[near], bits[near], others


def repeated_words(words: np.ndarray, sizes: np.ndarray, width: int = 5) -> np.ndarray:
    """For each text the words that lie in a window of `width` words found twice or more in it. words: a number for every
    word of all texts, the same for equal words. Windows are sorted by hash and compared in full with their neighbours."""
    n = len(words)
    text = np.repeat(np.arange(len(sizes)), sizes)
    covered = np.zeros(n + 1, np.int64)
    if n >= width:
        m = n - width + 1
        mixed = spread(words)
        hashed = spread(text[:m])
        for k in range(width):
            hashed = hashed * np.uint64(0x2545F4914F6CDD1D) + mixed[k : k + m]
        places = np.flatnonzero(text[:m] == text[width - 1 :])
        places = places[np.argsort(hashed[places], kind="stable")]
        same = hashed[places[1:]] == hashed[places[:-1]]
        left, right = places[:-1][same], places[1:][same]
        equal = text[left] == text[right]
        for k in range(width):
            equal &= words[left + k] == words[right + k]
        if not equal.all():  # different windows of one hash: compare them by their words
            hits = np.unique(np.concatenate([left, right]))
            keys = np.stack([text[hits], *(words[hits + k] for k in range(width))], axis=1)
            _, which, times = np.unique(keys, axis=0, return_inverse=True, return_counts=True)
            hits = hits[times[which.reshape(-1)] > 1]
        else:
            hits = np.unique(np.concatenate([left, right]))
        np.add.at(covered, hits, 1)
        np.add.at(covered, hits + width, -1)
    inside = np.concatenate([[0], np.cumsum(np.cumsum(covered[:-1]) > 0)])
    ends = np.cumsum(sizes)
    return inside[ends] - inside[ends - sizes]


def base_counts(texts: pa.Array) -> dict[str, np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of each text."""
    cut = pc.ascii_split_whitespace(texts)
    coded = cut.flatten().dictionary_encode()
    words = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    per = pc.list_value_length(cut).to_numpy(zero_copy_only=False).astype(np.int64)
    chars = pc.utf8_length(coded.dictionary).to_numpy(zero_copy_only=False).astype(np.int64)[words]
    text = np.repeat(np.arange(len(texts)), per)
    there = chars > 0
    words, text, chars = words[there], text[there], chars[there]
    sizes = np.bincount(text, minlength=len(texts))
    lines = pc.split_pattern(texts, "\n")
    line = lines.flatten().dictionary_encode()
    codes = line.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    owner = np.repeat(np.arange(len(texts)), pc.list_value_length(lines).to_numpy(zero_copy_only=False))
    some = pc.not_equal(pc.ascii_trim_whitespace(line.dictionary), "").to_numpy(zero_copy_only=False)[codes]
    codes, owner = codes[some], owner[some]
    first = np.unique(owner * max(1, len(line.dictionary)) + codes) // max(1, len(line.dictionary))
    return {
        "n_words": sizes,
        "word_chars": np.bincount(text, chars, minlength=len(texts)).astype(np.int64),
        "n_symbols": pc.count_substring_regex(texts, "[#*$%&|<>]").to_numpy(zero_copy_only=False).astype(np.int64),
        "n_dup_lines": np.bincount(owner, minlength=len(texts)) - np.bincount(first, minlength=len(texts)),
        "n_repeat_words": repeated_words(words, sizes),
    }


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _measure(shared, languages: list[str], letters: list[np.ndarray], kept: list[str]):
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, tables = pa.array(languages), spellings(letters)
        numbers, values, others = shared.value
        bits = np.full(len(languages) * CODES, -1, np.int32)
        bits[numbers] = values
        for batch in batches:
            texts = pc.fill_null(batch.column("text"), "")
            every = pc.index_in(batch.column("language"), names).to_numpy(zero_copy_only=False).astype(np.int64)
            for at, n in steps(texts, STEP_BYTES):
                part, which = texts.slice(at, n), every[at : at + n]
                points, lengths, codes, far = _windows(part, tables, which)
                codes += np.repeat((which * CODES).astype(np.int32), lengths)
                found = bits[codes]
                del codes
                grams, text = _grams(points, lengths, far)
                for k in np.unique(which[text]).tolist():
                    of = which[text] == k
                    found[far[of]] = _find(*others[k], grams[of], -1) if len(others[k][0]) else -1
                rest = np.flatnonzero(found < 0)
                found[rest] = 0
                asked, text = _grams(points, lengths, rest)
                ends = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=n))]).astype(np.int32)
                some = lengths > 0
                total = np.zeros(n, np.int64)
                total[some] = np.add.reduceat(found, (np.cumsum(lengths) - lengths)[some], dtype=np.int64) if some.any() else 0
                del points, found
                counts = base_counts(part)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(c).slice(at, n) for c in [*kept, "language"]),
                        *(pa.array(counts[c]) for c in COUNTS),
                        pa.array(total),
                        pa.array(which.astype(np.int32)),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(asked)),
                    ],
                    [*kept, "language", *COUNTS, "total", "which", "rest"],
                )

    return measure


def _with_rest(measured: DataFrame, values: DataFrame) -> DataFrame:
    """Measured rows with the bits of the trigrams that were not known to all tasks."""
    stored = settle(measured.withColumn("row", F.monotonically_increasing_id()), "partly-measured")
    asked = stored.select("row", "which", F.explode("rest").alias("gram")).join(values, ["which", "gram"])
    answers = asked.groupBy("row").agg(F.sum("bits").alias("more"))
    total = F.col("total") + F.coalesce("more", F.lit(0))
    whole = settle(stored.drop("rest").join(answers, "row", "left").withColumn("total", total).drop("row", "more"), "measured")
    forget(stored)
    return whole


def measure(docs: DataFrame, key: str = "doc_id", text: str = "text", language: str = "lang", also: tuple[str, ...] = ()) -> DataFrame:
    """Of every row: its id (and the columns `also`), language group, base counts, bits per word, perplexity per word, the
    bounds of its language's band, base_failed and kept. The measured rows are stored, since the bands need all.

    Null and empty texts have zero counts, no perplexity and fail; a language column that is null counts as pooled. An
    empty table gives no rows. Models and bands are of distinct texts that pass the base rules; without any, the band is
    empty. Texts are read three times, for their alphabets, to count and to measure, and shuffled once, to find the distinct
    ones. Trigrams beyond KNOWN are shuffled as well, once for each place.
    """
    spark = docs.sparkSession
    own = own_languages(docs, language)
    languages = [*own, *([POOLED] if POOLED not in own else [])]
    named = [F.col(key).alias("doc_id"), *(F.col(c) for c in also)]
    rows = docs.select(*named, F.col(text).alias("text"), _language(F.col(language).cast("string"), own).alias("language"))
    letters = alphabets(rows, languages)
    digest = F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_digest_")
    distinct = rows.groupBy("language", digest).agg(F.first("text").alias("text"))
    values = train(distinct.select("text", "language"), languages, letters)
    whole = values.count() <= KNOWN
    known = values if whole else values.orderBy(F.desc("n"), "which", "gram").limit(KNOWN)
    shared = spark.sparkContext.broadcast(_known(known.select("which", "gram", "bits").toArrow(), letters))
    rows = rows.withColumn("text_digest_", digest)
    kept = ["doc_id", *also, "text_digest_"]
    head = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*kept).schema)
    schema = f"{head}, language string, " + ", ".join(f"{c} bigint" for c in COUNTS) + ", total bigint, which int, rest array<bigint>"
    measured = rows.mapInArrow(_measure(shared, languages, letters, kept), schema)
    measured = settle(measured.drop("rest"), "measured") if whole else _with_rest(measured, values)
    bits = F.when(F.col("n_words") > 0, F.col("total") / F.lit(float(UNIT)) / F.col("n_words"))
    measured = measured.withColumn("bits", bits).drop("total", "which")
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    good = measured.where(~failed).groupBy("language", "text_digest_").agg(F.first("bits").alias("bits"))

    def by_language(value: Column) -> dict[str, float]:  # a row per language group
        return {r["language"]: r["m"] for r in good.groupBy("language").agg(F.percentile_approx(value, 0.5, 1000).alias("m")).collect()}

    def of_language(values: dict[str, float]) -> Column:
        out = F.lit(None).cast("double")
        for name, value in values.items():
            out = F.when(F.col("language") == name, F.lit(value)).otherwise(out)
        return out

    medians = by_language(F.col("bits"))
    spreads = by_language(F.abs(F.col("bits") - of_language(medians)))
    reach = {name: max(REACH * spreads[name], LEAST_REACH * m) for name, m in medians.items()}
    low = of_language({name: m - reach[name] for name, m in medians.items()})
    high = of_language({name: m + reach[name] for name, m in medians.items()})
    measured = measured.drop("text_digest_")
    short = F.lit(SHORT_REACH) / F.sqrt(F.greatest(F.col("n_words"), F.lit(1)))
    low, high = low - short, high + short
    inside = F.coalesce(F.col("bits").between(low, high), F.lit(False))
    return (
        measured.withColumn("base_failed", failed)
        .withColumn("lowest", F.pow(F.lit(2.0), low))
        .withColumn("highest", F.pow(F.lit(2.0), high))
        .withColumn("perplexity", F.pow(F.lit(2.0), F.col("bits")))
        .withColumn("kept", ~F.col("base_failed") & inside)
    )


def keep_good(docs: DataFrame, key: str = "doc_id", text: str = "text", language: str = "lang") -> DataFrame:
    """The rows of docs, in all their columns, that the rules keep. Rows with equal id and text share their verdict."""
    wrapped = wrap(docs, key, text).withColumn("digest", F.xxhash64(F.coalesce("text", F.lit(""))))
    rows = wrapped.select("doc_id", "text", "digest", F.col("whole").getField(language).alias("lang"))
    bad = measure(rows, also=("digest",)).where(~F.col("kept")).select(F.col("doc_id").alias("id"), F.col("digest").alias("d")).distinct()
    return unwrap(wrapped.join(bad.hint("shuffle_hash"), F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("digest") == F.col("d")), "left_anti"))
