"""Toxicity: a noisy channel restores obfuscated words, then the restored text is scored.

The channel knows three tricks: letters written as digits or symbols, letters repeated, and words
spelled out with a separator between single letters. Each suspicious piece becomes a lattice, in
which a character may stand for itself or for what it imitates, and a run may stand for one letter
or two; the Viterbi path under a four-gram character model wins. The model's counts are taken over
every whole text of the table. A piece without digits, imitating symbols or runs has one path only,
itself, so ordinary words pass untouched.

Scoring is by restored words. In the training fold, words and word beginnings that stand far more
often in toxic texts than elsewhere get a weight; a text's score is a logistic function of the
weights it holds, their number, the largest, and how many words there are (long texts hold more by chance).
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.learn import fit_logistic, held_out, labelled_sample, sigmoid, slices, texts_of
from tessera.runtime import Scratch, ship_package, spread

#: Characters of the model: word boundary, a-z, digit, other letter, anything else in a word.
SYMBOLS = 30
SPACE = SYMBOLS**4
#: What a character may stand for, with the channel's probability; the rest is for itself.
LEET = {"0": {"o": 0.9}, "1": {"i": 0.6, "l": 0.3}, "2": {"z": 0.5}, "3": {"e": 0.9}, "4": {"a": 0.9}, "5": {"s": 0.9}, "6": {"g": 0.5, "b": 0.3}, "7": {"t": 0.9}, "8": {"b": 0.8}, "9": {"g": 0.8},
        "@": {"a": 0.95}, "$": {"s": 0.95}, "!": {"i": 0.7, "l": 0.2}, "|": {"l": 0.5, "i": 0.4}, "+": {"t": 0.9}, "(": {"c": 0.9}, "€": {"e": 0.9}, "£": {"l": 0.8}, "¡": {"i": 0.9}, "*": {c: 0.03 for c in "aeiou"}}
#: At most so many labelled rows are gathered for training.
SAMPLE_ROWS = 12_000
PREFIXES = (4, 5, 6)
MEMO_WORDS = 200_000
#: Spelled-out runs are read in overlapping parts, so a word of half this length at most is whole in one.
PART = 40

_IMITATES = re.escape("".join(c for c in LEET if not c.isdigit()))
_WORD = rf"[^\W_]"
#: letters and imitations in one piece, with at least one of each; a run of three; letters spelled out.
_MIXED = re.compile(rf"(?=[0-9{_IMITATES}]*{_WORD}*?[^\W\d_])(?:{_WORD}|[{_IMITATES}])+")
_SUSPECT = re.compile(rf"(?:[^\W\d_][0-9{_IMITATES}]|[0-9{_IMITATES}][^\W\d_])|([^\W\d_])\1\1")
_LETTER = r"(?:[^\W_]|[@$!|+])"
_SPELLED = re.compile(rf"(?<![^\W_]){_LETTER}([ .\-_*~/,]){_LETTER}(?:\1{_LETTER})+(?![^\W_])")
_WORDS = re.compile(r"[^\W_]+")

_memos: dict[bytes, dict[str, str]] = {}


def _symbol_table() -> np.ndarray:
    t = np.zeros(256, np.int64)
    for c in range(256):
        ch = chr(c)
        if "a" <= ch <= "z":
            t[c] = c - 96
        elif "0" <= ch <= "9":
            t[c] = 27
        elif c >= 0xC0 and c not in (0xD7, 0xF7):
            t[c] = 28
        elif ch in "'$@":
            t[c] = 29
    return t


_TABLE = _symbol_table()


#: The same for code points; the last stands for all above U+00FF, which count as other letters.
_POINTS = np.append(_TABLE, 28)


def symbols(text: str) -> np.ndarray:
    """Model characters of a text."""
    low = text.lower()
    if low.isascii():
        return _TABLE[np.frombuffer(low.encode(), np.uint8)]
    return _POINTS[np.minimum(np.frombuffer(low.encode("utf-32-le", "surrogatepass"), np.uint32), 256)]


def count_fourgrams(docs: DataFrame, text: str) -> DataFrame:
    """(code, n) of all four-grams of model characters in all texts; each task sums its own first."""
    ship_package(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SPACE, np.int64)
        pad = np.zeros(3, np.int64)
        for b in batches:
            held, size = [], 0
            texts = b.column(0).to_pylist()
            for n, t in enumerate(texts):
                held += [pad, symbols(t)]
                size += len(t)
                if size > 1 << 20 or n == len(texts) - 1:
                    s = np.concatenate([*held, pad])
                    code = ((s[:-3] * SYMBOLS + s[1:-2]) * SYMBOLS + s[2:-1]) * SYMBOLS + s[3:]
                    total += np.bincount(code, minlength=SPACE)
                    held, size = [], 0
        codes = np.flatnonzero(total)
        for a in range(0, len(codes), 50_000):
            c = codes[a : a + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32()), pa.array(total[c], pa.int64())], names=["code", "n"])

    rows = docs.select(F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("t"))
    return rows.mapInArrow(run, "code int, n long").groupBy("code").agg(F.sum("n").alias("n"))


def language_model(counts: DataFrame) -> np.ndarray:
    """Log P(d | a, b, c) as a table. At most SYMBOLS ** 4 counts (0.8 million) reach the driver."""
    got = counts.toArrow()
    n = np.zeros(SPACE)
    n[got["code"].to_numpy()] = got["n"].to_numpy()
    n4 = n.reshape((SYMBOLS,) * 4)
    p = (n4.sum(axis=(0, 1, 2)) + 1) / (n4.sum() + SYMBOLS)
    for k in (2, 1, 0):
        c = n4.sum(axis=tuple(range(k))) if k else n4
        p = (c + 4.0 * p) / (c.sum(axis=-1, keepdims=True) + 4.0)
    return np.log(np.broadcast_to(p, n4.shape)).astype(np.float32).reshape(-1)


def _symbol(c: str) -> int:
    o = ord(c)
    return int(_TABLE[o]) if o < 256 else (28 if c.isalpha() else 0)


def decode(piece: str, lm: list[float], several: bool = False) -> str:
    """Viterbi over the piece's lattice; states are the last three characters of the restored word.

    With ``several``, a word may end after any character and the next one begin.
    """
    runs: list[tuple[str, int]] = []
    for c in piece.lower():
        if runs and runs[-1][0] == c:
            runs[-1] = (c, runs[-1][1] + 1)
        else:
            runs.append((c, 1))
    # a state is a number; its path is a chain of pieces, so that long ones cost no copies
    states: dict[int, tuple[float, tuple | None]] = {0: (0.0, None)}
    low = SYMBOLS**3
    for c, n in runs:
        options = _OPTIONS.get(c) or ((c, 0.0, _symbol(c)),)
        grown: dict[int, tuple[float, tuple | None]] = {}
        for x, cost, s in options:
            for m in (1,) if n == 1 else (1, 2) if n > 2 else (2, 1):
                price = cost * n + (0.0 if m == n else -3.0 if n == 2 else -0.7 * m)
                for key, (score, path) in states.items():
                    t = score + price
                    for _ in range(m):
                        key = key * SYMBOLS + s
                        t += lm[key]
                        key %= low
                    had = grown.get(key)
                    if had is None or t > had[0]:
                        grown[key] = (t, (path, x * m))
        if several:
            for key, (score, path) in list(grown.items()):
                t, to = score + lm[key * SYMBOLS], key * SYMBOLS % low
                if key % SYMBOLS and (to not in grown or t > grown[to][0]):
                    grown[to] = (t, (path, " "))
        states = grown
    path = max(states.items(), key=lambda kv: (kv[1][0] + lm[kv[0] * SYMBOLS], -kv[0]))[1][1]
    out = []
    while path is not None:
        path, x = path
        out.append(x)
    return "".join(reversed(out))


_OPTIONS = {c: tuple((x, float(np.log(p)), _symbol(x)) for x, p in [*stands.items(), (c, max(1 - sum(stands.values()), 1e-3))]) for c, stands in LEET.items()}


class Restorer:
    def __init__(self, lm: np.ndarray):
        self.lm = lm.tolist()
        mark = hashlib.blake2b(lm.tobytes()).digest()
        self.memo = _memos.setdefault(mark, {})

    def word(self, piece: str) -> str:
        w = self.memo.get(piece)
        if w is None:
            if len(self.memo) > MEMO_WORDS:
                self.memo.clear()
            # what hangs on the word's ends may be punctuation or a letter: both are tried
            bare = piece.strip("".join(c for c in LEET if not c.isalnum()))
            w = decode(bare, self.lm) if bare else piece
            if bare != piece:
                full = decode(piece, self.lm)
                w = f"{w} {full}" if full != w else w
            self.memo[piece] = w
        return w

    def spelled(self, letters: str) -> str:
        """Where one spelled word ends and the next begins isn't written: every cut is tried, and the model's own."""
        key = f" {letters}"
        w = self.memo.get(key)
        if w is None:
            x = self.word(letters)
            w = " ".join([x, *[f"{x[:k]} {x[k:]}" for k in range(1, len(x))], decode(letters, self.lm, True)])
            self.memo[key] = w
        return w

    def extra(self, text: str) -> list[str]:
        """Restored words of the text's suspicious pieces."""
        out = []
        m = _SPELLED.search(text)
        while m:
            letters = m.group()[::2]
            for a in range(0, max(len(letters) - PART // 2, 1), PART // 2):
                out.append(self.spelled(letters[a : a + PART]))
            # the last letter may be the first of a run with another separator
            m = _SPELLED.search(text, m.end() - 1)
        if _SUSPECT.search(text):
            for m in _MIXED.finditer(text):
                if _SUSPECT.search(m.group()):
                    out.append(self.word(m.group()))
        return out

    def words(self, text: str) -> set[str]:
        """Distinct lower-case words of the text and of its restored pieces."""
        low = text.lower()
        found = set(_WORDS.findall(low))
        more = self.extra(low)
        return found.union(*[_WORDS.findall(x) for x in more]) if more else found


def keys_of(words: set[str]) -> set[str]:
    return words.union(*[{w[:k] + "*" for w in words if len(w) >= k} for k in PREFIXES])


class Weights:
    """Weights of words and beginnings, and the logistic function of a text's total."""

    def __init__(self, weight: dict[str, float], map_: np.ndarray):
        self.weight, self.map = weight, map_
        self.whole = {k for k in weight if k[-1] != "*"}
        self.starts = {n: {k[:-1]: w for k, w in weight.items() if k[-1] == "*" and len(k) == n + 1} for n in PREFIXES}

    def totals(self, words: set[str]) -> tuple[float, float, float, float]:
        best: dict[str, float] = {w: self.weight[w] for w in words & self.whole}
        for n, table in self.starts.items():
            if table:
                for w in words:
                    x = table.get(w[:n])
                    if x is not None and x > best.get(w, 0.0):
                        best[w] = x
        v = best.values()
        return (float(sum(v)), float(len(v)), max(v, default=0.0), float(len(words)))

    def score(self, totals: np.ndarray) -> np.ndarray:
        return sigmoid(inputs(totals) @ self.map[:-1] + self.map[-1])


def weights_of(counts: dict[str, tuple[int, int]], n1: int, n0: int) -> Weights:
    """Log ratios of document shares, for keys over three times as likely in toxic texts and far beyond chance there.

    counts: in how many toxic texts and in how many others a key stands, of n1 and n0.
    """
    n1, n0 = max(n1, 1), max(n0, 1)
    weight = {}
    for k, (a, b) in sorted(counts.items()):
        lift = np.log((a + 0.1) / n1) - np.log((b + 0.5) / n0)
        expect = (a + b) * n1 / (n1 + n0)
        if lift > 1.1 and (a - expect) / np.sqrt(expect + 1e-9) > 5:
            weight[k] = float(min(lift, 8.0))
    return Weights(weight, np.zeros(5))


def inputs(totals: np.ndarray) -> np.ndarray:
    return np.column_stack([totals[:, 0] / 10, np.log1p(totals[:, 1]), totals[:, 2] / 5, np.log1p(totals[:, 3]) / 5])


def train(
    docs: DataFrame, labels: DataFrame, label: str = "toxic", sample_rows: int = SAMPLE_ROWS, min_count: int = 4, seed: int = 42, id_col: str = "doc_id", text: str = "text"
) -> tuple[np.ndarray, Weights | None]:
    """The language model over all texts, and the weights from at most sample_rows labelled ones.

    Keys are counted where the texts are; the driver gets those that stand in min_count toxic texts at least,
    and four numbers a labelled text.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "toxicity")
    lm = language_model(scratch.keep(count_fourgrams(docs, text), "fourgrams"))
    shared = spark.sparkContext.broadcast(lm)
    known = labelled_sample(labels, label, sample_rows, seed, id_col)
    picked = spread(texts_of(docs, known, id_col, text).select("__text", F.col("__id").cast("long"), F.col("__y").cast("int")))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = Restorer(shared.value)
        for b in slices(batches):
            words = pa.array([sorted(r.words(t)) for t in b.column(0).to_pylist()], pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([b.column(1), b.column(2), words], names=["id", "y", "w"])

    read_texts = scratch.keep(picked.mapInArrow(read, "id long, y int, w array<string>"), "labelled")
    sizes = {r["y"]: r["count"] for r in read_texts.groupBy("y").count().collect()}
    if not (sizes.get(1) and sizes.get(0)):
        return lm, None

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n: dict[str, list[int]] = {}
        table = lambda: pa.RecordBatch.from_pydict({"k": list(n), "a": [x[0] for x in n.values()], "b": [x[1] for x in n.values()]})
        for b in slices(batches):
            for y, w in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                for k in keys_of(set(w)):
                    n.setdefault(k, [0, 0])[1 - y] += 1
            if len(n) > 100_000:
                yield table()
                n.clear()
        if n:
            yield table()

    keys = read_texts.mapInArrow(count, "k string, a long, b long").groupBy("k").agg(F.sum("a").alias("a"), F.sum("b").alias("b")).where(F.col("a") >= min_count)
    weights = weights_of({r["k"]: (r["a"], r["b"]) for r in keys.collect()}, sizes[1], sizes[0])

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            t = np.array([weights.totals(set(w)) for w in b.column(2).to_pylist()]).reshape(-1, 4)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *(pa.array(c, pa.float64()) for c in t.T)], names=["id", "y", "s", "n", "m", "w"])

    got = read_texts.mapInArrow(total, "id long, y int, s double, n double, m double, w double").toArrow().sort_by([("id", "ascending")])
    weights.map = fit_logistic(inputs(np.column_stack([got[c].to_numpy() for c in ("s", "n", "m", "w")])), got["y"].to_numpy(), l2=1e-4)
    return lm, weights


def toxicity_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, id_col: str = "doc_id", text: str = "text", **params) -> DataFrame:
    """One row per document row: id, held_out, score, predicted, and the restored words that weigh most.

    Null texts are scored as empty ones. Ids may be null or repeat. Without labels of both kinds every
    score is 0; an empty table gives an empty result. Labels, language, source and id are no inputs, and
    other columns, whatever their names, are not read. Texts of any length are read whole.
    """
    spark = docs.sparkSession
    ship_package(spark)
    lm, weights = train(docs, labels, id_col=id_col, text=text, **params)
    shared = spark.sparkContext.broadcast((lm, weights))
    kind = docs.schema[id_col].dataType
    rows = spread(docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lm, weights = shared.value
        r = Restorer(lm)
        for b in slices(batches):
            texts = b.column(1).to_pylist()
            if weights is None:
                s, shown = np.zeros(len(texts)), [""] * len(texts)
            else:
                words = [r.words(t) for t in texts]
                s = weights.score(np.array([weights.totals(w) for w in words]).reshape(-1, 4))
                shown = [",".join(sorted(w & weights.whole, key=lambda k: (-weights.weight[k], k))[:5]) for w in words]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(s, pa.float64()), pa.array(shown, pa.string())], names=["id", "score", "terms"])

    schema = docs.select(F.col(f"`{id_col}`").alias("id")).schema.add("score", "double").add("terms", "string")
    out = rows.mapInArrow(run, schema)
    return out.select(F.col("id").cast(kind).alias(id_col), held_out(F.col("id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "terms")
