"""Packing of tokenised documents into sequences of fixed length by best fit and swap-based local search.

Pieces are dealt at random over groups of bounded size, each packed by one task: best fit, largest first, then
local search. It takes the emptiest bins and moves a document into another underfull bin, or exchanges one for one
or two for one, wherever that raises the sum of squared fills, so that full bins get fuller and the emptiest
run empty. What stays underfull in a group is dealt again over far fewer groups.
"""

import re
import zlib
from bisect import bisect_left, bisect_right, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from .common import batch_of, stored, text_bytes

LENGTH = 4096
END_ID = 1
#: Pieces in a group: bounds the memory of a task and its search, whatever the input.
GROUP = 40_000
#: Chunks of text whose ids a worker keeps, about 200 bytes each.
KNOWN = 1_000_000
#: Bins with more free tokens than this are dealt again.
UNDERFULL = 32
ROUNDS = 2

PIECE = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("piece", pa.int32()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids_crc32", pa.int64()),
        ("deal", pa.int64()),
    ]
)
PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, deal bigint"


#: What every chunk of plain characters consists of; each part is encoded for itself.
_PART = re.compile(r"[A-Za-zÀ-ÖØ-öø-įı-ž]+|[0-9]|[!-&(-/:-@\[-`{-~]+")
_PLAIN = re.compile(r"[0-9A-Za-zÀ-ÖØ-öø-įı-ž!-&(-/:-@\[-`{-~]+")


class ChunkIds:
    """Token ids of chunks without white space; the tokenizer never looks across white space.

    Chunks of Latin letters, digits and ASCII marks are encoded part by part, many new parts in one string: a part's
    ids end with the only one that closes a word. Others are encoded one by one.
    """

    def __init__(self, tokenizer, bound=KNOWN):
        self.tokenizer, self.bound, self.known, self.parts = tokenizer, bound, {}, {}
        suffix = getattr(tokenizer.model, "end_of_word_suffix", None)
        self.closes = np.zeros(max(tokenizer.get_vocab().values()) + 1, bool)
        if suffix:
            self.closes[[i for t, i in tokenizer.get_vocab().items() if t.endswith(suffix)]] = True
        probe = ["The", "Größe,", "(Élève)", "señor's", "a--b", "x2.50", "ſ", "ŒUVRE!!", "<|endoftext|>"]
        self.in_parts = bool(suffix)
        self._learn([c.encode() for c in probe])
        self.in_parts &= all(self.known[c.encode()] == self._ids([c])[0] for c in probe)
        self.known, self.parts = {}, {}

    def _ids(self, texts):
        coded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(c.ids, "<u4").tobytes() for c in coded]

    def _learn_parts(self, parts):
        """Encode parts, a thousand in a string."""
        for k in range(0, len(parts), 1000):
            some = parts[k : k + 1000]
            data = self._ids([" ".join(some)])[0]
            stops = (4 * (np.flatnonzero(self.closes[np.frombuffer(data, "<u4")]) + 1)).tolist()
            if len(stops) == len(some):
                self.parts.update(zip(some, map(data.__getitem__, map(slice, [0, *stops], stops)), strict=False))
            else:
                self.parts.update(zip(some, self._ids(some), strict=True))

    def _learn(self, chunks):
        words, plain, hard = [], [], []
        for chunk in chunks:
            text = chunk.decode("utf-8", "replace")
            if self.in_parts and chunk.isalpha():  # letters of ASCII: one part
                words.append((chunk, text))
            elif self.in_parts and _PLAIN.fullmatch(text) and "<|" not in text:
                plain.append((chunk, _PART.findall(text)))
            else:
                hard.append((chunk, text))
        every = {p for _, parts in plain for p in parts}.union(text for _, text in words)
        self._learn_parts(list(every.difference(self.parts)))
        self.known.update((chunk, self.parts[text]) for chunk, text in words)
        for chunk, parts in plain:
            self.known[chunk] = self.parts[parts[0]] if len(parts) == 1 else b"".join([self.parts[p] for p in parts])
        if hard:
            self.known.update(zip([c for c, _ in hard], self._ids([t for _, t in hard]), strict=True))

    def of(self, texts):
        """The ids of every text, as bytes."""
        chunks = [t.split() for t in texts]
        every = set().union(*chunks)
        new = every.difference(self.known)
        if new:
            if len(self.known) + len(new) > self.bound:
                self.known, self.parts, new = {}, {}, every
            self._learn(list(new))
        return [b"".join(map(self.known.__getitem__, c)) for c in chunks]


def _runs(sizes, most=1 << 18):
    """(start, stop) of runs of neighbours of about `most` bytes together."""
    start, total = 0, 0
    for i, size in enumerate(sizes):
        total += size
        if total >= most:
            yield start, i + 1
            start, total = i + 1, 0
    if start < len(sizes):
        yield start, len(sizes)


#: Kept by each worker from task to task, per tokenizer file and bound.
_KNOWN = {}


def _chunk_ids(path, bound):
    if (path, bound) not in _KNOWN:
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            _KNOWN[path, bound] = ChunkIds(Tokenizer.from_str(f.read()), bound)
    return _KNOWN[path, bound]


def tokenize(docs, tokenizer_path, length=LENGTH, end_id=END_ID, column="text", known=KNOWN):
    """One row per piece of every document: its ids, the end id, cut after every `length` ids.

    NULL and empty texts are the end id alone. Every row is a document, also where ids are NULL or repeated; the
    column ``deal`` is a random but repeatable number that tells repeated rows apart from nothing else. A worker keeps the
    ids of `known` chunks.
    """

    def scan(batches):
        chunks = _chunk_ids(tokenizer_path, known)
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            doc_ids, texts = (batch.column(c).to_pylist() for c in ("doc_id", "text"))
            for start, stop in _runs([len(t) for t in texts]):
                out = []
                for doc_id, ids in zip(doc_ids[start:stop], chunks.of(texts[start:stop]), strict=True):
                    ids += end
                    for k in range(0, len(ids), 4 * length):
                        part = ids[k : k + 4 * length]
                        crc = zlib.crc32(part)
                        deal = zlib.crc32(b"%d %d" % (doc_id or 0, k), crc)
                        out.append((doc_id, k // (4 * length), k // 4, len(part) // 4, crc, deal))
                yield batch_of(list(zip(*out, strict=True)), PIECE)

    given = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_bytes(column).alias("text"))
    return given.mapInArrow(scan, PIECES)


def best_fit(lengths, length):
    """Bins as lists of indices, largest piece first, each into the bin it fills best."""
    bins, room = [], []  # room: sorted (free, bin)
    for i in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[i])
        at = bisect_left(room, (size, -1))
        if at < len(room):
            free, b = room.pop(at)
        else:
            free, b = length, len(bins)
            bins.append([])
        bins[b].append(i)
        if free > size:
            insort(room, (free - size, b))
    return bins


def _gifts(members, size):
    """What one or two pieces of a bin hold together: total -> pieces, one piece where that is enough.

    Only sizes matter. Different sizes in a bin add up to no more than its length, so there are few, however many
    pieces it holds.
    """
    first, second = {}, {}
    for i in members:
        if first.setdefault(size[i], i) != i:
            second.setdefault(size[i], i)
    gifts = {s: [i] for s, i in first.items()}
    sizes = sorted(first)
    for x, s in enumerate(sizes):
        for t in sizes[:x]:
            gifts.setdefault(s + t, [first[s], first[t]])
        if s in second:
            gifts.setdefault(2 * s, [first[s], second[s]])
    return gifts


def _exchange(gifts, pieces, free):
    """(given, taken) that fill a bin with `free` tokens left the most, or None. `pieces` of that bin: size -> piece."""
    sums, best = sorted(gifts), None
    for s, j in pieces.items():
        at = bisect_right(sums, s + free) - 1
        if at >= 0 and sums[at] > s and (best is None or sums[at] - s > best[0]):
            best = (sums[at] - s, gifts[sums[at]], [j])
    return best and best[1:]


def improve(bins, lengths, length, passes=4):
    """Local search over underfull bins, emptiest first; every step raises the sum of squared fills.

    All underfull bins are partners of each other. Where the bins are as few as the tokens need, there is nothing to search.
    """
    size = lengths.tolist()
    fill = [sum(size[i] for i in b) for b in bins]
    if sum(map(bool, fill)) <= -(-sum(fill) // length):
        return [b for b in bins if b]
    for _ in range(passes):
        moved = False
        order = sorted((b for b in range(len(bins)) if 0 < fill[b] < length), key=lambda b: (fill[b], b))
        room = sorted((length - fill[b], b) for b in order)
        held = np.array([(size[i], b) for b in order for i in bins[b]], np.int64).reshape(-1, 2)
        held = np.unique(held, axis=0)
        changed, level = set(), np.array(fill, np.int64)

        def partners(a, gifts, held=held, changed=changed, level=level):
            """Bins in which some piece leaves room for more than itself, as they were, and bins that changed since."""
            sums = np.array(sorted(gifts), np.int64)
            at = np.searchsorted(sums, held[:, 0] + length - level[held[:, 1]], "right") - 1
            gains = (at >= 0) & (sums[at] > held[:, 0])
            return sorted({*held[gains, 1].tolist(), *changed} - {a}, key=lambda b: (length - fill[b], b))

        def shift(a, b, give, take, room=room, changed=changed, level=level):
            """Give pieces of a to b for pieces of b; b gets fuller by the difference."""
            nonlocal moved
            for x in (a, b):
                del room[bisect_left(room, (length - fill[x], x))]
            for i in give:
                bins[a].remove(i)
            for i in take:
                bins[b].remove(i)
            bins[a] += take
            bins[b] += give
            gain = sum(size[i] for i in give) - sum(size[i] for i in take)
            fill[a] -= gain
            fill[b] += gain
            changed.update((a, b))
            level[[a, b]] = fill[a], fill[b]
            for x in (a, b):
                if 0 < fill[x] < length:
                    insort(room, (length - fill[x], x))
                else:
                    insort(room, (length - fill[x], x)) if fill[x] else None
            moved = True

        for a in order:
            if not 0 < fill[a] < length:
                continue
            # Move: into the fullest bin that still takes the piece.
            for i in sorted(bins[a], key=lambda i: -size[i]):
                at = bisect_left(room, (size[i], -1))
                while at < len(room) and (room[at][1] == a or fill[room[at][1]] + size[i] <= fill[a]):
                    at += 1
                if at < len(room):
                    shift(a, room[at][1], [i], [])
            if not fill[a]:
                continue
            # Exchange one for one, or two for one, with any underfull bin that gains by it, the fullest first.
            gifts = _gifts(bins[a], size)
            for b in partners(a, gifts):
                if fill[b] < fill[a] or fill[b] == length or not fill[a]:
                    continue
                best = _exchange(gifts, {size[j]: j for j in bins[b]}, length - fill[b])
                if best:
                    shift(a, b, *best)
                    gifts = _gifts(bins[a], size)
        if not moved:
            break
    return [b for b in bins if b]


def _pack_group(length):
    def pack(key, rows):
        rows = rows.sort_values(["length", "doc_id", "piece", "deal"], kind="stable", ignore_index=True)
        lengths = rows["length"].to_numpy()
        whole = np.flatnonzero(lengths == length)
        part = np.flatnonzero(lengths < length)
        bins = improve(best_fit(lengths[part], length), lengths[part], length)
        bins = [[i] for i in whole.tolist()] + [part[b].tolist() for b in bins]
        number, offset, free = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
        for n, members in enumerate(bins):
            at = 0
            for i in members:
                number[i], offset[i] = n, at
                at += int(lengths[i])
            free[members] = length - at
        return rows.assign(sequence_id=(int(key[0]) << 32) + number, offset=offset, free=free)

    return pack


def pack(pieces, length=LENGTH, group=GROUP, rounds=ROUNDS):
    """`pieces` (doc_id, piece, start, length, ids_crc32, deal) with ``sequence_id`` and ``offset``.

    Every piece gets a place; an empty table gives none. A sequence holds pieces of any documents.
    """
    spark = pieces.sparkSession
    schema = f"grp bigint, {PIECES}, sequence_id bigint, offset bigint, free bigint"
    done, n, first = [], pieces.count(), 0
    for r in range(rounds):
        groups = max(1, -(-n // group))
        last = r == rounds - 1 or groups == 1
        grp = F.pmod(F.xxhash64("deal", "doc_id", "piece", F.lit(r)), F.lit(groups)) + F.lit(first)
        packed = (
            pieces.select(grp.alias("grp"), *PIECE.names)
            .groupBy("grp")
            .applyInPandas(_pack_group(length), schema)
        )
        packed = stored(packed, f"packing-{r}")
        if last:
            done.append(packed)
            break
        done.append(packed.filter(F.col("free") <= UNDERFULL))
        pieces = packed.filter(F.col("free") > UNDERFULL).select(*PIECE.names)
        n, first = pieces.count(), first + groups
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def pack_documents(docs, tokenizer_path, length=LENGTH, end_id=END_ID, group=GROUP, known=KNOWN):
    """Tokenise, cut and pack all documents."""
    return pack(stored(tokenize(docs, tokenizer_path, length, end_id, known=known), "pieces"), length, group)
