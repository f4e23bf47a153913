"""Best-fit packing by bin completion.

Texts are tokenised, each document's ids end with id 0, and only documents longer
than a sequence are cut.  Pieces are dealt by row number into groups of bounded
size, and each group is packed on its own: whole sequences first, then best-fit
decreasing as the incumbent, then, where the incumbent is above the lower
bound, a branch and bound that fills the bin of the largest open piece, trying
only undominated fillings, fullest first, and prunes by the waste that one bin
fewer leaves.  It is a limited discrepancy search, so its node budget goes to
the first bins as to the last; the best packing found stands.

Only lengths and check sums are shuffled, never ids; ``sequences`` makes the
token arrays on request.

Defined results: a null or empty text is the one id 0.  Ids repeat, rows with
equal or null ``doc_id`` are separate documents.  An empty table gives no rows.
"""

from __future__ import annotations

import os
import re
import zlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator
from heapq import heappop, heappush
from itertools import compress, islice

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bytehash import seeded
from .common import materialise

SEQUENCE = 2048
GROUP_PIECES = 8192
NODES = 20_000
NODES_PER_BIN = 12
FILLINGS = 4
STEPS = 200
TAIL = 64
DIVES = 3
DUAL_FUNCTIONS = 50
CACHE_WORDS = 600_000
CACHE_PIECES = 300_000
TOKENIZER = "word_bpe_49k.json"

# Words of these characters alone are split here; others go to the tokenizer whole.
_PLAIN = re.compile(r"[\x21-\x7eÀ-ÖØ-öø-ÿ]+")
# Fixed value: the word pattern of the tokenizer file, for the plain characters.
_PIECE = re.compile(r"\n|'s|'t|'re|'ve|'m|'ll|'d|[a-zÀ-ÖØ-öø-ÿ]+|[0-9]|[^\sa-z0-9À-ÖØ-öø-ÿ]+")
_WORD_END = "</w>"
# Stands for a line break among ids: the vocabulary's ids end with zero bytes, so it is in none.
_BREAK = b"\xff\xff\xff\xff"
BLOCK_CHARS = 1 << 22


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


class WordTokenizer:
    """Ids of whole texts, little-endian uint32 bytes, equal to the tokenizer's.

    The tokenizer drops white space and no piece crosses it, so the ids of a text
    are those of its words in order; words are cached (bounded), and words of
    plain letters, digits and signs are split into pieces that are cached too.
    """

    def __init__(self, path: str, cache_words: int = CACHE_WORDS):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers
        self.full = Tokenizer.from_file(path)
        self.bare = Tokenizer(self.full.model)
        self.bare.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        vocabulary = self.full.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for w, i in vocabulary.items() if w.endswith(_WORD_END)]] = True
        self.words: dict[bytes, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        self.limit = cache_words

    def _whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.full.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn_pieces(self, new: list[str]) -> None:
        ids = np.array(self.bare.encode_batch_fast([" ".join(new)], add_special_tokens=False)[0].ids, "<u4")
        cut = np.flatnonzero(self.ends[ids]) + 1
        if len(cut) != len(new):
            self.pieces.update(zip(new, self._whole(new)))
            return
        raw, cut = ids.tobytes(), (4 * cut).tolist()
        self.pieces.update(zip(new, (raw[a:b] for a, b in zip([0] + cut[:-1], cut))))

    def _learn(self, words: set[bytes]) -> None:
        if len(self.words) + len(words) > self.limit:
            self.words.clear()
        if len(self.pieces) > CACHE_PIECES:
            self.pieces.clear()
        order = list(words)
        texts = b"\n".join(order).decode("utf-8", "replace").split("\n")
        plain = [_PLAIN.fullmatch(s) is not None and "<|" not in s for s in texts]
        # All plain words at once, a line each.
        parts = _PIECE.findall("\n".join(compress(texts, plain)).lower())
        known = self.pieces
        known["\n"] = _BREAK
        new = {p for p in parts if p not in known}
        if new:
            self._learn_pieces(list(new))
        if parts:
            self.words.update(zip(compress(order, plain), b"".join(map(known.__getitem__, parts)).split(_BREAK)))
        odd = [i for i, p in enumerate(plain) if not p]
        if odd:
            self.words.update(zip([order[i] for i in odd], self._whole([texts[i] for i in odd])))

    def ids(self, texts: list[str]) -> Iterator[bytes]:
        """Ids of each text; new words are learnt together for about BLOCK_CHARS of text."""
        block, size = [], 0
        for text in texts:
            block.append(text)
            size += len(text)
            if size > BLOCK_CHARS:
                yield from self._block(block)
                block, size = [], 0
        yield from self._block(block)

    def _block(self, texts: list[str]) -> Iterator[bytes]:
        get = self.words.get
        split = [text.encode("utf-8", "replace").split() for text in texts]
        got = [list(map(get, words)) for words in split]
        holes = [[i for i, x in enumerate(ids) if x is None] for ids in got]
        missing = {words[i] for words, at in zip(split, holes) for i in at}
        if missing:
            self._learn(missing)
        for words, ids, at in zip(split, got, holes):
            for i in at:
                ids[i] = get(words[i])
            yield b"".join(ids)


_loaded: dict[str, WordTokenizer] = {}


def loaded(path: str) -> WordTokenizer:
    """The worker's tokenizer: loaded once, its cache kept between tasks."""
    if path not in _loaded:
        _loaded[path] = WordTokenizer(path)
    return _loaded[path]


def pieces(docs: DataFrame, path: str, text: str = "text", doc_id: str = "doc_id", limit: int = SEQUENCE,
           with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids, on request): each
    document's ids and a last id 0, cut into pieces of ``limit`` ids."""
    extra = ", ids binary" if with_ids else ""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokens = loaded(path)
        for batch in batches:
            rows = []
            keys = batch["doc_id"].tolist()
            texts = ["" if t is None else t for t in batch["text"].tolist()]
            for key, raw in zip(keys, tokens.ids(texts)):
                raw += b"\0\0\0\0"
                n = len(raw) // 4
                for k, a in enumerate(range(0, n, limit)):
                    part = raw[4 * a:4 * (a + limit)]
                    rows.append((None if pd.isna(key) else int(key), k, a, len(part) // 4, zlib.crc32(part)) + ((part,) if with_ids else ()))
            out = pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"] + (["ids"] if with_ids else []))
            yield out.astype({"doc_id": "Int64"})

    d = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return d.mapInPandas(run, f"doc_id long, piece int, start long, length long, ids_crc32 long{extra}")


def lower_bound(sizes: list[int], limit: int) -> int:
    """Bins that any packing needs: the largest of the volume, of the bounds with pieces
    over ``limit - a`` alone and those over half of it unmatched for each threshold ``a``, and of
    the volumes after the dual feasible functions that round sizes down to k-ths of a bin
    (a size of exactly j / (k + 1) stays)."""
    if not sizes:
        return 0
    up = np.sort(np.array(sizes, np.int64))
    total = int(up.sum())
    best = -(-total // limit)
    prefix = np.concatenate(([0], np.cumsum(up)))
    for a in np.unique(up[up <= limit // 2]):
        alone = len(up) - int(np.searchsorted(up, limit - a, "right"))
        half = len(up) - int(np.searchsorted(up, limit // 2, "right")) - alone
        lo, hi = int(np.searchsorted(up, a, "left")), int(np.searchsorted(up, limit // 2, "right"))
        mid = int(prefix[len(up) - alone] - prefix[len(up) - alone - half])
        small = int(prefix[hi] - prefix[lo])
        best = max(best, alone + half + max(0, -(-(small - (half * limit - mid)) // limit)))
    for k in range(1, DUAL_FUNCTIONS + 1):
        parts, rest = np.divmod(up * (k + 1), limit)
        # In units of 1 / (k limit): k x where x (k + 1) is whole, else floor(x (k + 1)) limit.
        best = max(best, -(-int(np.where(rest == 0, k * up, parts * limit).sum()) // (k * limit)))
    return best


def best_fit(sizes: list[int], limit: int) -> list[list[int]]:
    """Best-fit decreasing: each piece goes to the fullest bin that holds it."""
    free: list[tuple[int, int]] = []
    bins: list[list[int]] = []
    for s in sorted(sizes, reverse=True):
        k = bisect_left(free, (s, -1))
        if k < len(free):
            room, b = free.pop(k)
        else:
            room, b = limit, len(bins)
            bins.append([])
        bins[b].append(s)
        if room > s:
            insort(free, (room - s, b))
    return bins


def fillings(sizes: list[int], counts: dict[int, int], room: int, most: int, steps: int) -> tuple[list[tuple[int, ...]], bool]:
    """Undominated fillings of ``room`` from the open sizes, fullest first, and
    whether these are all: a set is left out if one of its pieces could be
    exchanged for a larger open one that still fits, or another piece added.

    At most ``most`` are returned, of those found in ``steps`` (a step chooses a
    size and how often); the first found takes the largest that fits each time,
    so there is one always."""
    ends: list[tuple[int, tuple[tuple[int, int], ...]]] = []
    full, whole = 0, True

    def undominated(left: int, chosen: tuple[tuple[int, int], ...]) -> bool:
        if not left:
            return True
        used = dict(chosen)
        for c in (0, *used):
            a, b = bisect_right(sizes, c), bisect_right(sizes, c + left)
            if any(counts[x] > used.get(x, 0) for x in sizes[a:b]):
                return False
        return True

    def go(chosen: tuple[tuple[int, int], ...], left: int, at: int) -> None:
        nonlocal steps, full, whole
        steps -= 1
        k = min(at, bisect_right(sizes, left) - 1)
        if k < 0:
            ends.append((left, chosen))
            full += not left
        for j in range(k, -1, -1):
            s = sizes[j]
            fit = min(counts[s], left // s)
            # Of the smallest size, fewer than fit would leave room for another.
            for n in range(fit, 0 if j else fit - 1, -1):
                if ends and (steps <= 0 or full >= most):
                    whole = False
                    return
                go(chosen + ((s, n),), left - n * s, j - 1)

    go((), room, len(sizes) - 1)
    ends.sort(key=lambda f: (f[0], sum(n for _, n in f[1])))
    out = list(islice((chosen for left, chosen in ends if undominated(left, chosen)), most + 1))
    return [tuple(s for s, n in chosen for _ in range(n)) for chosen in out[:most]], whole and len(out) <= most


def fullest(sizes: list[int], counts: dict[int, int], room: int) -> list[int]:
    """The fullest filling of ``room`` from the open sizes (ascending), with the largest
    pieces first among equally full ones: the reachable sums of each beginning of the sizes are
    the bits of one integer."""
    k = bisect_right(sizes, room)
    mask, bits, reach = (1 << (room + 1)) - 1, 1, [1]
    for s in sizes[:k]:
        left, step = min(counts[s], room // s), 1
        while left:  # 1, 2, 4, ... pieces at a time
            n = min(step, left)
            bits |= bits << (s * n)
            left -= n
            step *= 2
        bits &= mask
        reach.append(bits)
    total, out = bits.bit_length() - 1, []
    while total:
        s = sizes[k - 1]
        n = next(n for n in range(min(counts[s], total // s), -1, -1) if reach[k - 1] >> (total - n * s) & 1)
        out += [s] * n
        total -= n * s
        k -= 1
    return out


class Open:
    """The pieces not yet in a bin; ``state`` is a hash of their sizes."""

    def __init__(self, counts: dict[int, int], code: dict[int, int], bins: list[list[int]]):
        self.counts, self.code = dict(counts), code
        for b in bins:
            for s in b:
                self.counts[s] -= 1
        self.sizes = sorted(s for s, n in self.counts.items() if n)
        self.state = sum(n * code[s] for s, n in self.counts.items())

    def take(self, pieces: list[int]) -> None:
        for s in pieces:
            self.counts[s] -= 1
            self.state -= self.code[s]
            if not self.counts[s]:
                del self.sizes[bisect_left(self.sizes, s)]


def last_bins_anew(sizes: list[int], limit: int, best: list[list[int]], least: int) -> list[list[int]]:
    """``best``, or fewer bins by dives that give the bin of the largest open piece its fullest
    filling, again and again: one from the start, then those that take another undominated
    filling once or twice in one of the last ``TAIL`` bins. A dive ends when more is wasted
    than one bin fewer than the best leaves, or at open pieces that were met before with as few
    bins. ``DIVES`` whole dives' worth of bins are filled at most."""
    every: dict[int, int] = {}
    for s in sizes:
        every[s] = every.get(s, 0) + 1
    code = dict(zip(sorted(every), seeded(len(every), 41).tolist()))
    total, left = sum(sizes), DIVES * len(best)
    met: dict[int, int] = {}
    number = 0
    # (other fillings taken, place from the end, number, bins of a dive, bin to fill otherwise)
    todo: list[tuple[int, int, int, list[list[int]], int]] = [(0, 0, 0, [], 0)]
    while todo:
        taken, _, _, path, at = heappop(todo)
        before = path[:at]
        waste = sum(limit - sum(b) for b in before)
        starts: list[list[int]] = [[]]
        if path:
            rest = Open(every, code, before)
            top = rest.sizes[-1]
            rest.take([top])
            found, _ = fillings(rest.sizes, rest.counts, limit - top, FILLINGS, STEPS)
            used = sorted(path[at])
            starts = [f for f in ([top, *f] for f in found) if sorted(f) != used]
        for start in starts:
            bins, lost, rest = list(before), waste, Open(every, code, before)
            if start:
                bins.append(start)
                rest.take(start)
                lost += limit - sum(start)
            while rest.sizes and lost <= (len(best) - 1) * limit - total and met.get(rest.state, len(bins) + 1) > len(bins):
                if not left:
                    return best
                left -= 1
                met[rest.state] = len(bins)
                top = rest.sizes[-1]
                rest.take([top])
                bins.append([top, *fullest(rest.sizes, rest.counts, limit - top)])
                rest.take(bins[-1][1:])
                lost += limit - sum(bins[-1])
            if not rest.sizes and len(bins) < len(best):
                best = bins
                if len(best) <= least:
                    return best
            first = max(at + bool(start), len(bins) - TAIL)
            if taken < 2:
                for i in range(len(bins) - 1, first - 1, -1):
                    number += 1
                    heappush(todo, (taken + 1, len(bins) - i, number, bins, i))
    return best


def spread(n: int) -> list[int]:
    """0 to n - 1 so that each beginning is spread over all (bits reversed)."""
    bits = max(1, (n - 1).bit_length())
    return sorted(range(n), key=lambda i: f"{i:0{bits}b}"[::-1])


def complete_bins(sizes: list[int], limit: int = SEQUENCE, nodes_per_bin: int = NODES_PER_BIN) -> list[list[int]]:
    """Bins of at most ``limit``: best fit, improved by bin completion until the
    lower bound or the node budget is reached.

    Dives by fullest fillings come first, with others in the last bins (``last_bins_anew``).
    Then limited discrepancy search: a dive gives each bin its fullest filling; then
    come the dives that take another filling once, at bins spread over the whole
    path, then twice, and so on.  Where fillings were left untested, the search
    starts again with four times as many."""
    best = best_fit(sizes, limit)
    least = lower_bound(sizes, limit)
    if len(best) > least:
        best = last_bins_anew(sizes, limit, best, least)
    if len(best) <= least:
        return best
    every: dict[int, int] = {}
    for s in sizes:
        every[s] = every.get(s, 0) + 1
    total = sum(sizes)
    nodes = max(NODES, nodes_per_bin * len(best))
    spent, most, steps, whole = 0, FILLINGS, STEPS, False
    while not whole:
        whole = True
        # (other fillings taken, place, number, an earlier dive's bins, how many of them, the bins that follow)
        todo: list[tuple[int, int, int, list[list[int]], int, list[list[int]]]] = [(0, 0, 0, [], 0, [])]
        number = 0
        while todo:
            taken, _, _, before, kept, start = heappop(todo)
            bins, counts = before[:kept] + start, dict(every)
            for s in (s for b in bins for s in b):
                counts[s] -= 1
            live = sorted(s for s in counts if counts[s])
            # One bin fewer than the best leaves this much waste in all.
            spare = (len(best) - 1) * limit - total - sum(limit - sum(b) for b in bins)
            others = []
            while live and spare >= 0:
                if spent >= nodes:
                    return best
                top = live[-1]
                counts[top] -= 1
                if not counts[top]:
                    live.pop()
                found, all_of_them = fillings(live, counts, limit - top, most, steps)
                spent += steps // STEPS  # a node with more steps counts for more
                whole &= all_of_them
                others += [(len(bins), [top, *f]) for f in found[1:] if limit - top - sum(f) <= spare]
                for s in found[0]:
                    counts[s] -= 1
                    if not counts[s]:
                        del live[bisect_left(live, s)]
                bins.append([top, *found[0]])
                spare -= limit - sum(bins[-1])
            if not live and len(bins) < len(best):
                best = bins
                if len(best) <= least:
                    return best
            for at, i in enumerate(spread(len(others))):
                number += 1
                heappush(todo, (taken + 1, at, number, bins, others[i][0], [others[i][1]]))
        most, steps = 4 * most, 4 * steps
    return best


def pack(parts: DataFrame, limit: int = SEQUENCE, group_pieces: int = GROUP_PIECES,
         nodes_per_bin: int = NODES_PER_BIN) -> DataFrame:
    """``parts`` with ``sequence_id`` and ``offset``.

    Pieces are written with a row number and dealt by its hash into groups of
    about ``group_pieces`` (the count grows with the input, a group does not, nor
    with equal rows).  Full pieces are a sequence each."""
    names = parts.columns
    rows = materialise(parts.withColumn("_row", F.monotonically_increasing_id()), "pieces")
    groups = max(1, round(rows.count() / group_pieces))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in parts.schema) + ", sequence_id long, offset long"
    dealt = rows.select(*names, F.pmod(F.xxhash64("_row"), F.lit(groups)).cast("long").alias("_g"))

    def run(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        group = group.drop(columns="_g").sort_values(["length", *[n for n in names if n != "length"]], kind="stable").reset_index(drop=True)
        sizes = group["length"].to_numpy()
        places: dict[int, list[tuple[int, int]]] = {}
        small = sizes[sizes < limit].tolist()
        bins = complete_bins(small, limit, nodes_per_bin) + [[limit]] * int((sizes >= limit).sum())
        for b, members in enumerate(bins):
            at = 0
            for s in members:
                places.setdefault(s, []).append((b, at))
                at += s
        took: dict[int, int] = {}
        spots = []
        for s in sizes.tolist():
            k = took.get(s, 0)
            took[s] = k + 1
            spots.append(places[s][k])
        first = int(key[0]) << 32
        group["sequence_id"] = [first + b for b, _ in spots]
        group["offset"] = [a for _, a in spots]
        return group

    return dealt.repartition(groups, "_g").groupBy("_g").applyInPandas(run, schema)


def pack_documents(docs: DataFrame, path: str | None = None, text: str = "text", doc_id: str = "doc_id",
                   limit: int = SEQUENCE, **options) -> DataFrame:
    """Where each piece of each document lies: doc_id, piece, start, length,
    ids_crc32, sequence_id, offset."""
    return pack(pieces(docs, path or tokenizer_path(), text, doc_id, limit), limit, **options)


def sequences(docs: DataFrame, packed: DataFrame, path: str | None = None, text: str = "text", doc_id: str = "doc_id",
              limit: int = SEQUENCE) -> DataFrame:
    """sequence_id and its token ids, from the documents and their places; needs
    unique ids of documents.  A sequence holds ``limit`` ids at most."""
    ids = pieces(docs, path or tokenizer_path(), text, doc_id, limit, with_ids=True).select("doc_id", "piece", "ids")
    joined = packed.join(ids, ["doc_id", "piece"])
    parts = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "piece", "ids")))
    out = joined.groupBy("sequence_id").agg(parts.alias("parts"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"sequence_id": b["sequence_id"], "ids": [
                np.frombuffer(b"".join(p["ids"] for p in ps), "<u4").astype("int64") for ps in b["parts"]]})

    return out.mapInPandas(run, "sequence_id long, ids array<long>")
