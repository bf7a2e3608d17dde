"""Alignment of the token sequences of two tokenizers, byte by byte.

Tokenizer A is a byte-level BPE (``tokenizers``), applied to a space and the text; tokenizer B is a sentencepiece model,
which adds that space itself. The character offsets of A and the spans of B's proto are coarse cuts. Where tokens
share a character, or a byte-fallback token has no surface of its own, the decoded bytes of the tokens refine them.

Neither tokenizer has tokens that reach over a space that follows a non-space, so texts are cut there, and a
chunk is aligned once per task however often it occurs. Texts are taken in parts of bounded size. A part keeps the
distinct pairs of ids it links and, per document, places in that list, so what meets the corpus-wide counts is one row
per part and distinct pair, and no token sequence is shuffled. What is kept per document travels as one compressed value
per part and meets the counts in Python, part by part: neither side is collected into rows or batches of many parts.
"""

import gc
import re
from functools import cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import functions as F

from .common import give_back, small_batches, stored, text_bytes

#: Bytes of text in a part; a longer text is a part of its own.
PART_BYTES = 1_000_000
#: Parts in a stored file: a file's rows are read as one batch.
FILE_PARTS = 32
#: Chunks that a task remembers, of at most CHUNK_CHARS characters each.
KNOWN_CHUNKS = 250_000
CHUNK_CHARS = 64
#: A pair of ids as one number.
SHIFT = 32

#: A space after a non-space where more than white space follows. What this takes for white space holds all that
#: tokenizer A takes for it.
_CUT = re.compile(r"(?<=\S) (?=\s*\S)")
_BYTE = re.compile(r"<0x([0-9A-Fa-f]{2})>")


def byte_alphabet():
    """The character that stands for each byte in byte-level vocabularies: printable ones stand for themselves."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    chars = {b: chr(b) for b in plain}
    for b in range(256):
        if b not in chars:
            chars[b] = chr(256 + len(chars) - len(plain))
    return chars


def byte_ends(lengths, begins, ends):
    """Where each token ends: at its span where that holds as many bytes as the token, else by its decoded bytes."""
    decoded = np.cumsum(lengths)
    holds = (begins == decoded - lengths) & (ends - begins == lengths)
    return np.where(holds, ends, decoded)


def places(text):
    """The byte at which each character of a text begins, and its end."""
    code = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    return np.concatenate([[0], np.cumsum(1 + (code >= 0x80) + (code >= 0x800) + (code >= 0x10000))])


def link(ends_a, ends_b):
    """Index pairs of tokens with overlapping ranges: one for each stretch between neighbouring ends of either side."""
    stretch = np.sort(np.concatenate([ends_a, ends_b]), kind="stable")
    stretch = stretch[np.diff(stretch, prepend=-1) > 0]
    return stretch, np.searchsorted(ends_a, stretch), np.searchsorted(ends_b, stretch)


class Aligner:
    """Both tokenizers of a task, with what it knows of chunks seen before."""

    def __init__(self, a_file=None, b_file=None):
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        a_file, b_file = files(a_file, b_file)
        self.a = Tokenizer.from_file(a_file)
        self.a.encode_special_tokens = True  # their strings are plain text
        self.b = SentencePieceProcessor(model_file=b_file)
        back = {c: b for b, c in byte_alphabet().items()}
        self.a_bytes = {
            i: bytes(back[c] for c in token) if all(c in back for c in token) else token.encode()
            for token, i in self.a.get_vocab().items()
        }
        self.b_bytes = [self._piece(i) for i in range(self.b.get_piece_size())]
        n_a, n_b = max(self.a_bytes) + 1, len(self.b_bytes)
        self.a_sizes = np.array([len(self.a_bytes.get(i, b"")) for i in range(n_a)])
        self.b_sizes = np.array([len(x) for x in self.b_bytes])
        # How an id is written inside a side of a group, and at its end.
        self.a_inside, self.a_last = (np.array([f"{i}{x}" for i in range(n_a)], object) for x in ",|")
        self.b_inside, self.b_last = (np.array([f"{i}{x}" for i in range(n_b)], object) for x in ",;")
        self.known = {}

    def _piece(self, i):
        piece = self.b.id_to_piece(i)
        if self.b.is_byte(i) and (m := _BYTE.fullmatch(piece)):
            return bytes([int(m[1], 16)])
        return piece.replace("▁", " ").encode()

    def tokens(self, text):
        """(ids of A, their ends, ids of B, their ends) of a text that is not empty, or None where its bytes do not
        come back. Ends count bytes from the space before the text.
        """
        spaced = " " + text
        whole = spaced.encode()
        one = self.a.encode(spaced, add_special_tokens=False)
        other = self.b.encode(text, return_type="offset_mapping", return_bytes=True)
        a, b = np.array(one.ids, np.int64), np.array(other["ids"], np.int64)
        if b"".join(map(self.a_bytes.__getitem__, one.ids)) != whole:
            return None
        if b"".join(map(self.b_bytes.__getitem__, other["ids"])) != whole:
            return None
        begins, ends = (np.array(x, np.int64) for x in zip(*one.offsets, strict=True))
        if len(whole) != len(spaced):
            place = places(spaced)
            begins, ends = place[begins], place[ends]
        # The space before the text is no part of B's spans.
        from_b, to_b = (np.array(x, np.int64) + 1 for x in zip(*other["offsets"], strict=True))
        from_b[0] = 0
        return a, byte_ends(self.a_sizes[a], begins, ends), b, byte_ends(self.b_sizes[b], from_b, to_b)

    def aligned(self, chunks):
        """What is to know of each chunk: (groups as text, tokens of A, of B, groups, pairs of ids), or None.

        Chunks that end in no white space stand next to each other in one text, as they do in documents. Where the bytes
        of such a text do not come back, its halves are tried.
        """
        found = self.tokens(" ".join(chunks))
        stops = np.cumsum([len(c.encode()) + 1 for c in chunks])
        if found is not None:
            a, ends_a, b, ends_b = found
            common = np.intersect1d(ends_a, ends_b, assume_unique=True)
            cut_at = np.minimum(np.searchsorted(common, stops), len(common) - 1)
        if found is None or not (common[cut_at] == stops).all():
            if len(chunks) == 1:
                return [None]
            half = len(chunks) // 2
            return self.aligned(chunks[:half]) + self.aligned(chunks[half:])
        stretch, i, j = link(ends_a, ends_b)
        pairs = a[i] << SHIFT | b[j]
        # Written group by group: the ids of A, then those of B.
        group_a, group_b = np.searchsorted(common, ends_a), np.searchsorted(common, ends_b)
        out = np.empty(len(a) + len(b), object)
        out[np.arange(len(a)) + np.searchsorted(group_b, group_a)] = np.where(
            common[group_a] == ends_a, self.a_last[a], self.a_inside[a]
        )
        out[np.arange(len(b)) + np.searchsorted(group_a, group_b, "right")] = np.where(
            common[group_b] == ends_b, self.b_last[b], self.b_inside[b]
        )
        written = out.tolist()
        to_a, to_b, to_link = (np.searchsorted(x, stops) + 1 for x in (ends_a, ends_b, stretch))
        told, at, link_at = [], 0, 0
        counts = [np.diff(x, prepend=0).tolist() for x in (to_a, to_b, cut_at + 1)]
        for n_a, n_b, n_groups, stop in zip(*counts, to_link.tolist(), strict=True):
            n = n_a + n_b
            told.append(("".join(written[at : at + n]), n_a, n_b, n_groups, pairs[link_at:stop].tobytes()))
            at, link_at = at + n, stop
        return told

    def chunks(self, distinct):
        """What is to know of each of these chunks."""
        new = [c for c in distinct if c not in self.known]
        if len(self.known) + len(new) > KNOWN_CHUNKS:  # keep what occurs here
            self.known = {c: self.known[c] for c in distinct if c in self.known}
        known, rare, joined = self.known, {}, []
        for c in new:
            if len(c) > CHUNK_CHARS or not c or c[-1].isspace():
                rare[c] = self.aligned([c])[0]
            else:
                joined.append(c)
        for at in range(0, len(joined), 1_000):
            some = joined[at : at + 1_000]
            known.update(zip(some, self.aligned(some), strict=True))
        return [rare[c] if c in rare else known[c] for c in distinct] if rare else [known[c] for c in distinct]


@cache
def aligner_of(a_file, b_file):
    """One per worker, with what it knows: a bounded number of chunks."""
    return Aligner(a_file, b_file)


def files(a_file=None, b_file=None):
    if a_file is None or b_file is None:
        import public_tokenizers

        a_file = a_file or public_tokenizers.path("byte_bpe_50k.json")
        b_file = b_file or public_tokenizers.path("piece_bpe_32k.model")
    return a_file, b_file


def cut(text):
    """The chunks of a text given as bytes, each without the space before it; none where there is no text."""
    try:
        return _CUT.split(text.decode()) if text else []
    except UnicodeDecodeError:
        return []


PART = pa.schema(
    [
        ("part", pa.int64()),
        ("pairs", pa.list_(pa.int64())),
        ("held_by", pa.list_(pa.int32())),
        ("docs", pa.binary()),
    ]
)
#: What ``docs`` holds.
DOCS = pa.schema(
    [
        ("doc_ids", pa.list_(pa.int64())),
        ("n_a", pa.list_(pa.int64())),
        ("n_b", pa.list_(pa.int64())),
        ("n_groups", pa.list_(pa.int64())),
        ("digests", pa.list_(pa.string())),
        ("n_distinct", pa.list_(pa.int32())),
        ("places", pa.list_(pa.int32())),
        ("times", pa.list_(pa.int32())),
    ]
)


def _row(row, schema):
    return pa.RecordBatch.from_arrays([pa.array([row[f.name]], f.type) for f in schema], schema=schema)


def _squeezed(batch):
    """A batch as one compressed value."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _part(aligner, part, doc_ids, texts):
    """One row of PART: all that the documents of a part link, with the pairs of ids as places in one list."""
    lists = [cut(t) for t in texts]
    flat = [c for chunks in lists for c in chunks]
    distinct = list(dict.fromkeys(flat))
    known = aligner.chunks(distinct)
    number = {c: k for k, c in enumerate(distinct)}
    at = np.fromiter(map(number.__getitem__, flat), np.int64, len(flat))
    sizes = np.array(list(map(len, lists)), np.int64)
    doc = np.repeat(np.arange(len(lists)), sizes)
    broken = np.array([v is None for v in known], bool)
    whole = np.bincount(doc, broken[at], len(lists)) == 0  # documents of which all chunks come back
    at, doc, sizes = at[whole[doc]], doc[whole[doc]], np.where(whole, sizes, 0)
    known = [v or ("", 0, 0, 0, b"") for v in known]
    row = {"part": part, "doc_ids": doc_ids}
    for name, k in (("n_a", 1), ("n_b", 2), ("n_groups", 3)):
        each = np.array([v[k] for v in known], np.int64)
        row[name] = np.bincount(doc, each[at], len(lists)).astype(np.int64)
    written, order, stop, row["digests"] = [v[0] for v in known], at.tolist(), 0, []
    for n in sizes.tolist():
        start, stop = stop, stop + n
        text = "".join([written[k] for k in order[start:stop]])[:-1]
        row["digests"].append(sha256(text.encode()).hexdigest() if n else "")
    n_links = np.array([len(v[4]) // 8 for v in known], np.int64)
    starts = np.cumsum(n_links) - n_links
    pairs = np.frombuffer(b"".join([v[4] for v in known]), np.int64)
    row["pairs"], place = np.unique(pairs, return_inverse=True)
    n = n_links[at]
    within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    base = max(1, len(row["pairs"]))
    own, often = np.unique(np.repeat(doc, n) * base + place[np.repeat(starts[at], n) + within], return_counts=True)
    row["places"], row["times"] = own % base, often
    row["n_distinct"] = np.bincount(own // base, minlength=len(lists))
    row["held_by"] = np.bincount(own % base, minlength=len(row["pairs"]))
    row["docs"] = _squeezed(_row(row, DOCS))
    return _row(row, PART)


def parts(docs, a_file=None, b_file=None):
    """The aligned documents, packed into parts."""

    def scan(batches):
        gc.set_threshold(1_000_000)  # many small values, and no cycles among them
        aligner = aligner_of(a_file, b_file)
        part, doc_ids, texts, size = TaskContext.get().partitionId() << 32, [], [], 0
        for batch in batches:
            ids, column = batch.column("doc_id").to_pylist(), batch.column("text")
            for k, doc_id in enumerate(ids):
                text = column[k].as_py()
                doc_ids.append(doc_id)
                texts.append(text)
                size += len(text)
                if size >= PART_BYTES or len(texts) >= PART_BYTES // 50:
                    yield _part(aligner, part, doc_ids, texts)
                    part, doc_ids, texts, size = part + 1, [], [], 0
        if texts:
            yield _part(aligner, part, doc_ids, texts)
        give_back()

    given = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_bytes("text").alias("text"))
    return given.mapInArrow(scan, "part bigint, pairs array<bigint>, held_by array<int>, docs binary")


def pair_counts(packed):
    """``pair, n_docs``: in how many documents of these parts a pair of ids is linked."""
    each = packed.select(F.explode(F.arrays_zip("pairs", "held_by")).alias("x"))
    return each.groupBy(F.col("x.pairs").alias("pair")).agg(F.sum("x.held_by").alias("n_docs"))


def split_pair(pair="pair"):
    return F.shiftright(pair, SHIFT).alias("a"), F.col(pair).bitwiseAND((1 << SHIFT) - 1).alias("b")


def _tell(packed, looked_up):
    """The documents of a part with their counts looked up."""
    row = pa.ipc.open_stream(packed.column("docs")[0].as_buffer()).read_next_batch()
    row = {name: row.column(name)[0].values for name in row.schema.names}
    at = looked_up.column("place").to_numpy()
    count, best = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)  # each pair of a part has one row
    count[at] = looked_up.column("n_docs").to_numpy()
    best[at] = looked_up.column("best").to_numpy()
    place, times = row["places"].to_numpy(), row["times"].to_numpy().astype(np.int64)
    n = row["n_distinct"].to_numpy().astype(np.int64)
    ends = np.cumsum(n)

    def per_doc(values):
        total = np.concatenate([[0], np.cumsum(values)])
        return pa.array(total[ends] - total[ends - n])

    return pa.table(
        {
            "doc_id": row["doc_ids"],
            **{name: row[name] for name in ("n_a", "n_b", "n_groups")},
            "n_links": per_doc(times),
            "n_best": per_doc(times * best[place]),
            "count_sum": per_doc(times * count[place]),
            "groups_sha256": row["digests"],
        }
    )


REPORT = (
    "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, "
    "groups_sha256 string"
)


def report(docs, a_file=None, b_file=None):
    """One row per row of `docs`: its numbers of tokens, groups and links, how its links are supported, a digest.

    A link's count is the number of documents, corpus-wide, in which its two ids are linked. ``n_best`` says how many
    links have the highest count of their A id, ties included; ``count_sum`` adds up the counts.

    Texts that are NULL, empty or no valid UTF-8, and texts whose bytes do not come back from both token sequences,
    have no tokens: zeros and an empty digest. Rows are documents of their own, also where ids are NULL or repeat. Other
    columns of `docs` are neither read nor returned. Very long texts are cut at spaces and make a part of their own.
    """
    small_batches(docs.sparkSession)
    packed = stored(parts(docs, a_file, b_file), "aligned", rows=FILE_PARTS)
    counts = pair_counts(packed)
    # As many rows at most as A has ids.
    top = counts.groupBy(split_pair()[0]).agg(F.max("n_docs").alias("most"))
    judged = (
        counts.select("pair", "n_docs", split_pair()[0])
        .join(F.broadcast(top), "a")
        .select("pair", "n_docs", (F.col("n_docs") == F.col("most")).cast("int").alias("best"))
    )
    asked = packed.select(F.col("part").alias("asked_by"), F.posexplode("pairs").alias("place", "pair"))
    looked_up = asked.join(judged, "pair").select("asked_by", "place", "n_docs", "best").groupBy("asked_by")
    return packed.select("part", "docs").groupBy("part").cogroup(looked_up).applyInArrow(_tell, REPORT)


def groups(docs, a_file=None, b_file=None):
    """``doc_id, groups``: the ids of either side, and the bytes, between places where both sequences end a token.

    NULL, empty and unfaithful texts have no groups; ids that are NULL or repeat stay as they are.
    """
    schema = pa.list_(pa.struct([("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32())), ("size", pa.int32())]))

    def scan(batches):
        aligner = aligner_of(a_file, b_file)
        for batch in batches:
            for k, doc_id in enumerate(batch.column("doc_id").to_pylist()):
                text, out = batch.column("text")[k].as_py(), []
                found = aligner.tokens(text.decode()) if cut(text) else None
                if found is not None:
                    a, ends_a, b, ends_b = found
                    common = np.intersect1d(ends_a, ends_b, assume_unique=True)
                    in_a, in_b = np.searchsorted(ends_a, common) + 1, np.searchsorted(ends_b, common) + 1
                    sides = (np.split(x, y[:-1]) for x, y in ((a, in_a), (b, in_b)))
                    sizes = np.diff(common, prepend=0)
                    out = [{"a": x, "b": y, "size": n} for x, y, n in zip(*sides, sizes, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([doc_id], pa.int64()), pa.array([out], schema)], names=["doc_id", "groups"]
                )

    given = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_bytes("text").alias("text"))
    return given.mapInArrow(scan, "doc_id bigint, groups array<struct<a: array<int>, b: array<int>, size: int>>")
