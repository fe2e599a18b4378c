"""Toxicity by noisy-channel deobfuscation.

A character trigram model is counted over all texts. A token that looks disguised
(digits or signs among letters, separators between letters, letters drawn out, or
letters set apart by spaces) becomes a lattice: each seen character may stand for
itself, for letters that it is used for, or for nothing. The Viterbi path under the
trigram model restores the word; a second path, on which a separator may also end a
word, restores the words of a phrase set apart in the same way. Restored and plain words then give evidence: the
log-odds, learned from labelled texts, of the word and of its first letters. A logistic
model over a text's strongest evidence gives the score; it is fitted on evidence that
each half of the labelled texts gets from the other half, so that it isn't fooled by
words that only one group of copies has.
"""

from __future__ import annotations

import math
import re
import unicodedata
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Labelled rows that the classifier is fitted on, at most: those of smallest XXH64 of the id.
FIT_ROWS = 32_768
#: Texts with a feature, at least, for it to have a weight.
LEAST = 3
PREFIXES = range(3, 7)
#: Letters that a digit or sign is used for.
LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "li", "+": "t", "€": "e", "£": "l", "(": "c", "<": "c"}
SEPARATORS = ".-_*~'`/\\,:; "
#: Costs, as negative log-probabilities: a stand-in, a dropped separator, a dropped repeat.
STAND_IN, DROPPED, REPEAT = 1.0, 0.3, 0.7
SYMBOLS = 32

_letters_apart = re.compile(r"(?<!\S)(?:[^\s.,;:!?\"()\[\]{}][ .\-_*]){2,}[^\s.,;:!?\"()\[\]{}](?![^\s.,;:!?\"()\[\]{}])")
_edges = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in "@$") + "«»„“”‘’¿¡…–—"
_odd = re.compile(r"[0-9@$!|+€£(<.\-_*~'`/\\]|([^\W\d_])\1\1")
_letter = re.compile(r"[^\W\d_]")


def symbol(ch: str) -> int:
    """0 for what isn't a letter, 1 to 26 for a to z with accents taken off, 27 to 31 for other letters."""
    base = unicodedata.normalize("NFD", ch.lower())[:1]
    if "a" <= base <= "z":
        return ord(base) - 96
    return 27 + ord(base) % 5 if base.isalpha() else 0


_table = np.array([symbol(chr(c)) if not 0xD800 <= c <= 0xDFFF else 0 for c in range(0x10000)], np.uint8)


def trigram_counts(text: str) -> np.ndarray:
    """Counts of symbol trigrams of a text, by their number in base 32."""
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    s = _table[np.minimum(code, 0xFFFF)].astype(np.int32)
    if len(s) < 3:
        return np.zeros(SYMBOLS**3, np.int64)
    return np.bincount((s[:-2] << 10) | (s[1:-1] << 5) | s[2:], minlength=SYMBOLS**3)


def character_model(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Negative log-probabilities of a symbol after two others, counted over every text; 32^3 values."""

    def run(batches):
        total = np.zeros(SYMBOLS**3, np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                texts = [t for t in batch.column(0).slice(at, 256).to_pylist() if t]
                total += trigram_counts("\n\n".join(texts) + "\n\n")
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["gram", "n"])

    rows = docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).toArrow()
    count = np.zeros(SYMBOLS**3)
    count[rows["gram"].to_numpy()] = rows["n"].to_numpy()
    three = count.reshape(SYMBOLS, SYMBOLS, SYMBOLS)
    two = three.sum(0)
    one = (two.sum(0) + 1) / (two.sum() + SYMBOLS)
    two = (two + 4 * one) / (two.sum(1, keepdims=True) + 4)
    three = (three + 4 * two[None]) / (three.sum(2, keepdims=True) + 4)
    return -np.log(three).ravel()


def decode(token: str, model: np.ndarray, phrase: bool = False) -> str:
    """The likeliest letters behind a disguised token: the Viterbi path through its lattice.

    Of a phrase a separator may also be the end of a word, which gives a space. A state
    holds its path as links to shared beginnings, so a token may have any length.
    """
    best: dict[tuple[int, int], tuple[float, tuple | None]] = {(0, 0): (0.0, None)}
    drawn = {i for m in re.finditer(r"(.)\1\1+", token) for i in range(m.start() + 1, m.end())}
    for at, ch in enumerate(token):
        ways = []
        if _letter.match(ch):
            ways.append((ch, 0.0))
        elif ch not in SEPARATORS and ch not in LEET:
            ways.append((ch, 0.0))
        if ch in LEET:
            ways += [(x, STAND_IN) for x in LEET[ch]]
        if ch in SEPARATORS:
            ways.append(("", DROPPED))
            if phrase:
                ways.append((" ", DROPPED))
        if at in drawn:
            ways.append(("", REPEAT))
        nxt = {}
        for (a, b), (cost, out) in best.items():
            for x, more in ways:
                if x:
                    c = symbol(x)
                    key, now = (b, c), cost + more + model[(a << 10) | (b << 5) | c]
                else:
                    key, now = (a, b), cost + more
                if key not in nxt or now < nxt[key][0]:
                    nxt[key] = (now, (x, out) if x else out)
        best = nxt
    _, _, path = min(((cost + model[(a << 10) | (b << 5)], (a, b), out) for (a, b), (cost, out) in best.items()), key=lambda x: x[:2], default=(0.0, (0, 0), None))
    letters = []
    while path:
        letters.append(path[0])
        path = path[1]
    return "".join(reversed(letters))


def restored(token: str, model: np.ndarray) -> list[str]:
    """Readings of a token other than itself: decoded, the words of it as a phrase, and with drawn-out letters cut to one."""
    if len(token) < 3 or not _odd.search(token) or not _letter.search(token):
        return []
    out = [decode(token, model)]
    if any(ch in SEPARATORS for ch in token):
        out += decode(token, model, phrase=True).split()
    return [x for x in dict.fromkeys((*out, re.sub(r"(.)\1+", r"\1", out[0]))) if len(x) >= 3 and x != token]


def tokens(text: str | None) -> set[str]:
    """Distinct lower-case tokens without signs at their edges, and runs of letters set apart by spaces or signs."""
    low = (text or "").lower()
    out = {t.strip(_edges) or t for t in set(low.split())}
    if len(low) >= 5:
        for m in _letters_apart.finditer(low):
            out.update((m[0], m[0][2:], m[0][:-2]))  # a word of one letter may stand next to the run
    out.discard("")
    return out


def features(word: str) -> list[str]:
    """A word and its first letters."""
    return [f"={word}", *(word[:k] for k in PREFIXES if len(word) >= k)] if len(word) >= 3 else []


def readings(token: str, model: np.ndarray) -> list[str]:
    plain = [token] if " " not in token else []
    return plain + restored(token.replace(" ", "-") if " " in token else token, model)


class Weights:
    """Evidence of a text under learned weights of features; of a token it is the most that any reading has."""

    def __init__(self, weight: dict[str, float], model: np.ndarray):
        self.weight, self.model, self.known = weight, model, {}

    def token(self, t: str) -> float:
        got = self.known.get(t)
        if got is None:
            if len(self.known) > 300_000:
                self.known.clear()
            get = self.weight.get
            got = self.known[t] = max((get(f, 0.0) for w in readings(t, self.model) for f in features(w)), default=0.0)
        return got

    def __call__(self, text: str | None) -> tuple[float, float, float]:
        """The strongest evidence, the second strongest, and their number relative to the text's words, as a logarithm."""
        own = tokens(text)
        found = sorted((x for x in map(self.token, own) if x > 0), reverse=True)[:2] + [0.0, 0.0]
        return found[0], found[1], math.log1p(len(own))


def is_held_out(doc_id) -> bool:
    return zlib.crc32(str(doc_id).encode()) % 3 == 1


def training_labels(labels: DataFrame, id_col: str = "doc_id", label_col: str = "toxic", limit: int = FIT_ROWS) -> DataFrame:
    """At most ``limit`` (id, y, fold) of the rows that may be learned from; ids with no label or two are left out."""
    free = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.min(label_col).alias("lo"), F.max(label_col).alias("y"))
    free = free.where((F.col("lo") == F.col("y")) & (F.crc32(F.col("id").cast("string").cast("binary")) % 3 != 1))
    return free.select("id", F.col("y").cast("int").alias("y"), F.pmod(F.xxhash64("id", F.lit(5)), F.lit(2)).cast("int").alias("fold")).orderBy(F.xxhash64("id"), "id").limit(limit)


def _log_odds(tox: np.ndarray, clean: np.ndarray, n_tox: float, n_clean: float) -> np.ndarray:
    return np.log((tox + 0.25) / (n_tox + 0.5)) - np.log((clean + 0.25) / (n_clean + 0.5))


def _fit_logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    x = np.c_[np.ones(len(x)), x]
    w, ridge = np.zeros(x.shape[1]), np.diag([1e-6] + [1e-2] * (x.shape[1] - 1)) * max(1, len(x)) * 1e-2
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(x.T @ (x * (p * (1 - p) + 1e-9)[:, None]) + ridge, x.T @ (y - p) - ridge @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


class Scorer:
    """A fitted model: ``score(text)`` in 0 to 1."""

    def __init__(self, weights: Weights, linear: np.ndarray):
        self.weights, self.linear = weights, linear

    def score(self, text: str | None) -> float:
        return 1 / (1 + math.exp(-min(30.0, max(-30.0, float(self.linear @ [1.0, *self.weights(text)])))))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", limit: int = FIT_ROWS) -> Scorer:
    """Count characters over all texts, then learn from at most ``limit`` labelled ones.

    Every feature that LEAST of these toxic texts have, and more toxic than clean ones, has
    a weight; their number is bounded by that of the labelled texts. Rows without a text
    and repeated rows count like others; a label without a document is not used. Without
    labels of both kinds the score is the share of label 1 (0.5 if there are none).
    """
    model = character_model(docs, text_col)
    sc = docs.sparkSession.sparkContext
    known = training_labels(labels, id_col, label_col, limit)
    sample = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).join(F.broadcast(known), "id").select("y", "fold", "text")
    sent = sc.broadcast(model)

    def count(batches):
        kept: dict[str, list[str]] = {}
        for batch in batches:
            n, names, ys, folds = 0, [], [], []
            for y, fold, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                own = {""}
                for t in tokens(text):
                    got = kept.get(t)
                    if got is None:
                        if len(kept) > 25_000:
                            kept.clear()
                        got = kept[t] = [f for w in readings(t, sent.value) for f in features(w)]
                    own.update(got)
                names += own
                ys += [y] * len(own)
                folds += [fold] * len(own)
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(ys, pa.int32()), pa.array(folds, pa.int32())], names=["feature", "y", "fold"])

    each = sample.mapInArrow(count, "feature string, y int, fold int").groupBy("feature").agg(*(F.count_if((F.col("y") == y) & (F.col("fold") == k)).alias(f"n{y}{k}") for y in (0, 1) for k in (0, 1)))
    rows = each.where((F.col("feature") == "") | ((F.col("n10") + F.col("n11") >= LEAST) & (F.col("n10") + F.col("n11") > F.col("n00") + F.col("n01")))).toArrow().sort_by("feature").to_pydict()
    n = {k: np.array(rows[k], float) for k in ("n00", "n01", "n10", "n11")}
    if not rows["feature"] or rows["feature"][0] != "":
        return Scorer(Weights({}, model), np.zeros(4))
    all_of = {k: v[0] for k, v in n.items()}
    clean, tox = all_of["n00"] + all_of["n01"], all_of["n10"] + all_of["n11"]
    if not clean or not tox:
        return Scorer(Weights({}, model), np.array([30.0 if tox else -30.0, 0, 0, 0]))

    def weights(t, c, n_t, n_c, least) -> dict[str, float]:
        w = _log_odds(t, c, n_t, n_c)
        return {f: float(x) for f, x, k in zip(rows["feature"][1:], w[1:], t[1:], strict=True) if x > 1 and k >= least}

    by_fold = sc.broadcast([weights(n[f"n1{1 - k}"], n[f"n0{1 - k}"], all_of[f"n1{1 - k}"], all_of[f"n0{1 - k}"], LEAST - 1) for k in (0, 1)])

    def evidence(batches):
        use = [Weights(w, sent.value) for w in by_fold.value]
        for batch in batches:
            rows = [(y, *use[fold](text)) for y, fold, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True)]
            y, a, b, c = zip(*rows, strict=True) if rows else ([], [], [], [])
            yield pa.RecordBatch.from_arrays([pa.array(y, pa.int32()), *(pa.array(x, pa.float64()) for x in (a, b, c))], names=["y", "a", "b", "c"])

    got = sample.mapInArrow(evidence, "y int, a double, b double, c double").toArrow()
    x, y = np.column_stack([got[k].to_numpy() for k in "abc"]), got["y"].to_numpy().astype(float)
    return Scorer(Weights(weights(n["n10"] + n["n11"], n["n00"] + n["n01"], tox, clean, LEAST), model), _fit_logistic(x, y))


def with_score(docs: DataFrame, scorer: Scorer, text_col: str = "text", out: str = "score") -> DataFrame:
    """All columns of ``docs`` and the score of each row's whole text.

    Null and empty texts get the score of no evidence; equal texts get equal scores, and
    repeated rows and null ids stay. No rows give no rows. A column of docs that is named
    like ``out`` is replaced.
    """
    docs = docs.drop(out) if out != text_col else docs
    sent = docs.sparkSession.sparkContext.broadcast((scorer.weights.weight, scorer.weights.model, scorer.linear))
    at = docs.columns.index(text_col)

    def run(batches):
        weight, model, linear = sent.value
        score = Scorer(Weights(weight, model), linear).score
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([score(t) for t in batch.column(at).to_pylist()], pa.float64())], names=[*batch.schema.names, out])

    from pyspark.sql.types import DoubleType, StructType

    schema = StructType([*docs.schema.fields]).add(out, DoubleType())
    return docs.mapInArrow(run, schema)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A score of every document. A null id is not held out; nulls, empty texts, repeated rows and empty tables as in ``fit`` and ``with_score``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    scorer = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return with_score(docs, scorer).select("doc_id", (F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 3 == 1).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))
