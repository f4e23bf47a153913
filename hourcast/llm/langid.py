"""Language of mixed text: script ranges narrow the candidates, then Viterbi over
per-word scores with a switching penalty labels spans.

The model counts, for every language, the hashed byte n-grams (1 to 4, with word
edges) and the scripts of all training texts.  A word's score in a language is the
sum of its n-grams' log probabilities; languages that do not write the word's
script (that of most of its letters) are ruled out, if another does; letters of no listed
script rule out none.  Words end at every character that is no letter or mark, and where the
script changes, so unspaced text of two scripts is words of both.  The path through the words pays
``SWITCH`` for each change of language; the text's language is the one with the
most letters on the path, and the score is its share of them.

Long texts are read in pieces of about ``PIECE_BYTES``, cut between words (or inside a word
longer than that), and scores are looked up for a bounded number of positions at a time, so
memory grows neither with a text nor with the number of languages.

Counting is a Spark aggregation over (language, bucket); the model is languages x
``BUCKETS`` numbers, whatever the input.  Texts of a batch go through Viterbi in
step, so Python's work is one step for a word position, not for a word.

Defined results: ``und`` with score 0 for a null text, one without a letter, and
where nothing was learned.  Ties go to the smaller language.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bytehash import CHUNK_BYTES, chunks, lower_table

BUCKETS = 1 << 15
ORDERS = (1, 2, 3, 4)
SWITCH = 12.0
SCALE = 0.5
SCRIPT_SHARE = 0.01
UNKNOWN = "und"
PIECE_BYTES = 1 << 20
CELLS = 1 << 23      # scores (positions x languages) looked up at once

# First bytes of UTF-8 by script range (code points from, to).
SCRIPTS = (
    ("latin", 0x0041, 0x024F), ("greek", 0x0370, 0x03FF), ("cyrillic", 0x0400, 0x052F), ("armenian", 0x0530, 0x058F),
    ("hebrew", 0x0590, 0x05FF), ("arabic", 0x0600, 0x077F), ("indic", 0x0900, 0x0DFF), ("southeast", 0x0E00, 0x0FFF),
    ("kana", 0x3040, 0x30FF), ("han", 0x3400, 0x9FFF), ("hangul", 0xAC00, 0xD7A3),
)


def script_table() -> np.ndarray:
    """Script (1-based; 0 for none) of two leading UTF-8 bytes."""
    t = np.zeros(1 << 16, np.uint8)
    for k, (_, lo, hi) in enumerate(SCRIPTS, 1):
        for cp in range(lo, hi + 1, 1 if hi < 0x800 else 64):
            b = chr(cp).encode()
            if hi < 0x800 and not chr(cp).isalpha():
                continue
            if len(b) == 1:
                t[(b[0] << 8):(b[0] << 8) + 256] = k
            else:
                t[(b[0] << 8) + b[1]] = k
    return t


_SCRIPT = script_table()
OTHER = len(SCRIPTS) + 1  # letters of no script above
_LETTER = np.fromiter((chr(cp).isalpha() for cp in range(0x110000)), bool, 0x110000)
_IN_WORD = _LETTER | np.fromiter((unicodedata.category(chr(cp))[0] == "M" for cp in range(0x110000)), bool, 0x110000)
# Scripts that one language mixes inside a word count as one where words end.
_GROUP = np.arange(OTHER + 1, dtype=np.uint8)
_GROUP[[k for k, (name, _, _) in enumerate(SCRIPTS, 1) if name in ("kana", "han")]] = OTHER + 1


def separators() -> np.ndarray:
    """Bytes that part words on their own: all ASCII but letters."""
    t = np.zeros(256, bool)
    t[:128] = True
    t[65:91] = t[97:123] = False
    return t


def code_points(raw: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Code points of the characters of two and more bytes that begin at ``at``."""
    b = np.append(raw, [0] * 3).astype(np.int64)
    lead, *low = (b[at + i] & (0x3F if i else 0xFF) for i in range(4))
    cp = np.where(lead < 0xE0, (lead & 0x1F) << 6 | low[0], np.where(
        lead < 0xF0, (lead & 0x0F) << 12 | low[0] << 6 | low[1], (lead & 0x07) << 18 | low[0] << 12 | low[1] << 6 | low[2]))
    return np.minimum(cp, 0x10FFFF)


def scripts_of(raw: np.ndarray, at: np.ndarray, cp: np.ndarray) -> np.ndarray:
    """Script of each position (0 for none, ``OTHER`` for a letter of none listed)."""
    two = (raw[:-1].astype(np.int64) << 8) | raw[1:]
    out = np.append(_SCRIPT[two], 0)
    none = out[at] == 0
    out[at[none & _LETTER[cp]]] = OTHER
    out[at[~_IN_WORD[cp]]] = 0
    return out


def parted(text: bytes) -> bytes:
    """The text with a space wherever two letters of different scripts meet."""
    raw = np.frombuffer(text, np.uint8)
    at = np.flatnonzero(raw >= 0xC2)
    if not len(at):
        return text
    group = _GROUP[scripts_of(np.append(raw, 0).astype(np.uint8), at, code_points(raw, at))[:-1]]
    letters = np.flatnonzero(group)
    width = np.where(raw[letters] < 0x80, 1, np.where(raw[letters] < 0xE0, 2, np.where(raw[letters] < 0xF0, 3, 4)))
    meet = (letters[:-1] + width[:-1] == letters[1:]) & (group[letters[:-1]] != group[letters[1:]])
    meet &= (group[letters[:-1]] != OTHER) & (group[letters[1:]] != OTHER)
    return np.insert(raw, letters[1:][meet], 32).tobytes() if meet.any() else text


def pieces(text: bytes, limit: int = PIECE_BYTES) -> list[bytes]:
    """The text cut at white space, or else between characters, into pieces of about
    ``limit`` bytes."""
    out = []
    while len(text) > limit:
        cut = max(text.rfind(c, 0, limit) for c in (b" ", b"\n", b"\t"))
        if cut <= 0:
            cut = limit
            while text[cut] & 0xC0 == 0x80:
                cut -= 1
        out.append(text[:cut])
        text = text[cut:]
    return [*out, text]


def prepared(texts: list) -> Iterator[tuple[list[int], list[bytes]]]:
    """(owning text, piece) lists of chunks of bounded size."""
    owners, parts, size = [], [], 0
    for first, group in chunks(texts):
        for i, t in enumerate(group, first):
            for p in pieces(t):
                p = parted(p)
                if parts and size + len(p) > CHUNK_BYTES:
                    yield owners, parts
                    owners, parts, size = [], [], 0
                owners.append(i)
                parts.append(p)
                size += len(p) + 1
    if parts:
        yield owners, parts


class Batch:
    """Words and hashed n-grams of a chunk of texts."""

    def __init__(self, texts: list[bytes]):
        sep = separators()
        raw = np.frombuffer(b" " + b"\n".join(texts) + b"\n" * max(ORDERS), np.uint8)
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        of = 1 + np.concatenate(([0], np.cumsum(lengths + 1)))
        gap = sep[raw]
        at = np.flatnonzero(raw >= 0xC2)
        cp = code_points(raw, at)
        for i in np.flatnonzero(~_IN_WORD[cp]):
            gap[at[i]:at[i] + (2 if raw[at[i]] < 0xE0 else 3 if raw[at[i]] < 0xF0 else 4)] = True
        self.wide = at, cp
        gap[of[1:] - 1] = True
        edge = np.flatnonzero(gap[1:] != gap[:-1]) + 1
        self.start, self.end = edge[0::2], edge[1::2]
        self.bounds = np.searchsorted(self.start, of)
        self.raw, self.gap = raw, gap
        b = lower_table()[raw]
        b[gap] = 32
        self.b = b.astype(np.uint64)

    def grams(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(bucket per position, valid) for each order: the n bytes that end there,
        at most the first and the last of them a word edge."""
        n = len(self.b)
        inside = ~self.gap
        for k, order in enumerate(ORDERS):
            h = np.zeros(n, np.uint64)
            for j in range(order):
                h[order - 1:] += self.b[order - 1 - j:n - j] << np.uint64(8 * j)
            bucket = ((h * np.uint64(0x9E3779B97F4A7C15) + np.uint64(k * 0x51ED270B)) >> np.uint64(49)).astype(np.int64)
            if order == 1:
                ok = inside
            else:
                ok = np.zeros(n, bool)
                middle = np.ones(n - order + 1, bool)
                for j in range(1, order - 1):
                    middle &= inside[j:n - order + 1 + j]
                first, last = inside[:n - order + 1], inside[order - 1:]
                ok[order - 1:] = middle & ((first | last) if order > 2 else (first | last))
            yield bucket, ok

    def scripts(self) -> np.ndarray:
        """Script of each position (0 for none, ``OTHER`` for a letter of none listed)."""
        return scripts_of(self.raw, *self.wide)

    def word_scripts(self) -> tuple[np.ndarray, np.ndarray]:
        """(script, letters) of each word: the script of most of its letters (ties: the earlier
        listed); ``OTHER`` counts where no letter is of a listed one."""
        n, kinds = len(self.start), OTHER + 1
        s = self.scripts()
        at = np.flatnonzero(s)
        word = np.searchsorted(self.start, at, "right") - 1
        each = np.bincount(word * kinds + s[at], minlength=n * kinds).reshape(n, kinds)
        letters = each.sum(1)
        listed = each[:, 1:OTHER]
        script = np.where(listed.any(1), listed.argmax(1) + 1, np.where(letters > 0, OTHER, 0))
        return script.astype(np.uint8), letters


def counts(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, kind, bucket, n): n-gram counts (kind = order) and letters by script
    (kind 0) over all rows with a language."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, np.ndarray] = {}
        for batch in batches:
            for name, part in batch.groupby("lang"):
                sums = held.setdefault(name, np.zeros((len(ORDERS) + 1, BUCKETS), np.int64))
                for _, texts in prepared(part["text"].tolist()):
                    c = Batch(texts)
                    sums[0] += np.bincount(c.scripts(), minlength=BUCKETS)
                    for k, (bucket, ok) in enumerate(c.grams(), 1):
                        sums[k] += np.bincount(bucket[ok], minlength=BUCKETS)
        for name, sums in held.items():
            kind, bucket = np.nonzero(sums)
            yield pd.DataFrame({"lang": name, "kind": kind, "bucket": bucket, "n": sums[kind, bucket]})

    d = docs.select(F.col(lang).alias("lang"), F.col(text).alias("text")).filter("lang is not null and text is not null")
    out = d.mapInPandas(run, "lang string, kind int, bucket int, n long")
    return out.groupBy("lang", "kind", "bucket").agg(F.sum("n").alias("n"))


class Model:
    """Log probabilities (bucket, language) per order, and the scripts of languages."""

    def __init__(self, rows: pd.DataFrame):
        self.langs = sorted(rows["lang"].unique())
        at = {x: i for i, x in enumerate(self.langs)}
        c = np.zeros((len(ORDERS) + 1, BUCKETS, len(self.langs)))
        c[rows["kind"], rows["bucket"], [at[x] for x in rows["lang"]]] = rows["n"]
        # The last row, of zeros, is for positions where no n-gram ends.
        self.table = [np.vstack([SCALE * np.log((x + 0.5) / (x.sum(0) + 0.5 * BUCKETS)), np.zeros(len(at))]).astype(np.float32)
                      for x in c[1:]]
        letters = c[0][1:len(SCRIPTS) + 1]
        writes = letters / np.maximum(letters.sum(0), 1) >= SCRIPT_SHARE
        writes[~writes.any(1)] = True
        self.barred = np.vstack([np.zeros(len(self.langs), bool), ~writes, np.zeros(len(self.langs), bool)])

    def words(self, texts: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(scores by language, letters, bounds) of the words of all texts."""
        k = len(self.langs)
        scores, sizes, per = [], [], np.zeros(len(texts), np.int64)
        for owners, part in prepared(texts):
            c = Batch(part)
            grams = [np.where(ok, bucket, BUCKETS).astype(np.int32) for bucket, ok in c.grams()]
            ends = np.minimum(c.end + 1, len(c.raw))
            s = np.zeros((len(c.start), k), np.float32)
            # As many words at a time as have CELLS scores of positions.
            first = 0
            while first < len(c.start):
                last = max(first + 1, int(np.searchsorted(ends, c.start[first] + CELLS // k, "right")))
                a, b = int(c.start[first]), int(ends[last - 1])
                at = np.zeros((b - a + 1, k), np.float32)
                for table, bucket in zip(self.table, grams):
                    at[:-1] += table[bucket[a:b]]
                pairs = np.stack([c.start[first:last] - a, ends[first:last] - a], 1).ravel()
                s[first:last] = np.add.reduceat(at, pairs, axis=0)[::2]
                first = last
            kind, letters = c.word_scripts()
            s[self.barred[kind]] -= 1e4
            s[kind == 0] = 0
            scores.append(s)
            sizes.append(letters)
            np.add.at(per, owners, np.diff(c.bounds))
        return (np.concatenate(scores) if scores else np.zeros((0, k), np.float32),
                np.concatenate(sizes) if sizes else np.zeros(0, np.int64), np.concatenate(([0], np.cumsum(per))))

    def path(self, scores: np.ndarray, bounds: np.ndarray, switch: float = SWITCH) -> np.ndarray:
        """The language of each word: the best path, all texts in step."""
        n = np.diff(bounds)
        order = np.argsort(-n, kind="stable")
        order = order[n[order] > 0]
        if not len(order):
            return np.zeros(0, np.uint16)
        first, length = bounds[:-1][order], n[order]
        active = np.searchsorted(-length, -np.arange(length[0]), "left")
        best = np.zeros(len(scores), np.uint16)  # the best language of the word before
        stay = np.zeros(scores.shape, bool)
        v = scores[first].astype(np.float64)
        label = np.zeros(len(scores), np.uint16)
        final = np.zeros(len(order), np.uint16)
        live = len(order)
        for t in range(1, length[0]):
            a = active[t]
            if a < live:
                final[a:live] = v[a:].argmax(1)
                v, live = v[:a], a
            i = first[:a] + t
            top = v.max(1, keepdims=True) - switch
            stay[i] = v >= top
            best[i] = v.argmax(1)
            v = np.maximum(v, top) + scores[i]
            v -= v.max(1, keepdims=True)
        final[:live] = v.argmax(1)
        now = final
        for t in range(length[0] - 1, 0, -1):
            a = active[t]
            i = first[:a] + t
            here = now[:a]
            label[i] = here
            now[:a] = np.where(stay[i, here], here, best[i])
        label[first] = now
        return label


def train(docs: DataFrame, text: str = "text", lang: str = "lang") -> Model | None:
    rows = counts(docs, text, lang).toPandas()
    return Model(rows) if len(rows) else None


def identify(docs: DataFrame, model: Model | None, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, lang_pred, score, spans (lang, first word, words) of every text."""
    schema = "doc_id long, lang_pred string, score double, spans array<struct<lang string, first int, words int>>"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = batch["text"].tolist()
            out = [(UNKNOWN, 0.0, [])] * len(texts)
            if model is not None and texts:
                scores, size, bounds = model.words(texts)
                label = model.path(scores, bounds)
                owner = np.repeat(np.arange(len(texts)), np.diff(bounds))
                k = len(model.langs)
                share = np.bincount(owner * k + label, weights=size, minlength=len(texts) * k).reshape(-1, k)
                cut = np.flatnonzero((np.diff(label.astype(np.int64)) != 0) | (np.diff(owner) != 0)) + 1
                cut = np.concatenate(([0], cut, [len(label)])) if len(label) else np.zeros(1, np.int64)
                spans: list[list] = [[] for _ in texts]
                for a, b in zip(cut[:-1].tolist(), cut[1:].tolist()):
                    o = owner[a]
                    spans[o].append({"lang": model.langs[label[a]], "first": a - int(bounds[o]), "words": b - a})
                for i, t in enumerate(texts):
                    if t and share[i].sum() > 0 and any(map(str.isalpha, t)):
                        j = int(share[i].argmax())
                        out[i] = (model.langs[j], float(share[i, j] / share[i].sum()), spans[i])
                    elif t and any(map(str.isalpha, t)):
                        out[i] = (model.langs[0], 1.0 / k, spans[i])
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "lang_pred": [x[0] for x in out],
                                "score": [x[1] for x in out], "spans": [x[2] for x in out]})

    d = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return d.mapInPandas(run, schema)
