"""Byte-level BPE encoding and decoding by forced-boundary splitting.

A merge only ever makes vocabulary tokens. So when two neighbouring bytes
occur inside no token, no merge can span them: the cut between them is
certain, both sides are encoded on their own and the ids concatenated. Cuts
come from two places: the pre-tokenizer's pattern, and the table of byte
pairs that occur in no token. What is left between cuts is short, so a task
keeps the ids of pieces it has met (a bounded store) and long runs stay
cheap. The vocabulary is sent to tasks as one broadcast of fixed size.

Defined results: null and empty texts have no ids and decode to the empty
text; special tokens found in a text get their id, as the tokenizers library
does by default. Every row gives one row, repeated ids included.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import zlib
from array import array

import numpy as np
import regex
from pyspark.sql import DataFrame, SparkSession

from .common import arrow_map, column, prepare

# Fixed value: the pre-tokenizer pattern of the vocabulary. White space is
# spelled out, as the tokenizers library and Python differ on \x1c-\x1f.
_WS = r"\t-\r \x85\xa0  -     　"
PATTERN = (
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_WS}\p{{L}}\p{{N}}]+"
    rf"|[{_WS}]+(?![^{_WS}])|[{_WS}]+"
)


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def byte_letters() -> dict[str, int]:
    """Letter -> byte of the byte-level alphabet: printable bytes stand for
    themselves, the others for the letters from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(rest)}


def _raw(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass")


# Bytes of a run that the library may be given, see ``ForcedCutBPE``.
LIBRARY_RUN = 512
# Bytes that begin a visible character whatever follows (no white space has them).
_SHOWN = np.array([0x20 < b < 0x7F or (b >= 0xC3 and b not in (0xE1, 0xE2, 0xE3)) for b in range(256)])


def longest_run(text: str) -> int:
    """Bytes of the longest part between spaces before visible characters, at
    which every pre-token ends; no pre-token is longer."""
    raw = np.frombuffer(_raw(text), np.uint8)
    at = np.flatnonzero((raw[:-1] == 0x20) & _SHOWN[raw[1:]])
    return int(np.diff(at, prepend=0, append=len(raw)).max())


class Pieces(dict):
    """Piece -> its ids as little-endian 32-bit bytes; bounded."""

    def __init__(self, make, limit: int):
        super().__init__()
        self.make, self.limit = make, limit

    def __missing__(self, key):
        if len(self) >= self.limit:
            self.clear()
        out = self[key] = self.make(key)
        return out


class ForcedCutBPE:
    """``by_library``: an installed library splits and merges whole texts where the
    vocabulary's ids are in merge order (callers that only need the ids). Texts with
    a run longer than ``LIBRARY_RUN`` are cut here, and only their fragments merged
    there: its merging of one piece, and its pattern's lookahead, are quadratic."""

    def __init__(self, spec: str, by_library: bool = False):
        j = json.loads(spec)
        letters = byte_letters()
        vocab, merges = j["model"]["vocab"], j["model"]["merges"]
        self.bytes_of: dict[int, bytes] = {}
        for token, i in vocab.items():
            self.bytes_of[i] = bytes(letters[c] for c in token)
        self.special = {t["content"]: t["id"] for t in j.get("added_tokens", [])}
        special_ids = set(self.special.values())
        for content, i in self.special.items():
            self.bytes_of[i] = content.encode()
        self.special_re = regex.compile("|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self.first = [vocab[c] for c, _ in sorted(letters.items(), key=lambda x: x[1])]
        self.merge: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(merges):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.merge.setdefault((vocab[a], vocab[b]), (rank, vocab[a + b]))
        # inside[a * 256 + b]: bytes a, b are neighbours in some token
        self.inside = bytearray(256 * 256)
        for token in self.bytes_of.values():
            for a, b in zip(token, token[1:]):
                self.inside[a * 256 + b] = 1
        self.pattern = regex.compile(PATTERN)
        self.blank_run = regex.compile(rf" [{_WS}]")
        self.unit = regex.compile(rf" (?=[^{_WS}])")
        self.trie: dict = {}
        for i, token in self.bytes_of.items():
            if i in special_ids:
                continue
            node = self.trie
            for b in token:
                node = node.setdefault(b, {})
            node[-1] = i
        of_bytes = {token: i for i, token in self.bytes_of.items() if i not in special_ids}
        self.length = {i: len(token) for token, i in of_bytes.items()}
        self.shorter = {
            i: next((of_bytes[token[:k]] for k in range(len(token) - 1, 0, -1) if token[:k] in of_bytes), -1)
            for token, i in of_bytes.items()
        }
        made = [i for _, i in self.merge.values()]
        self.merged_by = None
        if by_library and made == sorted(made) and all(i < made[0] for i in self.first):
            import tiktoken

            ranks = {token: i for token, i in of_bytes.items() if len(token) == 1 or i >= made[0]}
            library = tiktoken.Encoding("fragments", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})._core_bpe
            self.merged_by, self.whole_by = library.encode_single_piece, library.encode_ordinary
        self.pair_fits = Pieces(self._pair, 400_000)
        self.token_ids = Pieces(lambda t: self._pretoken(_raw(t)), 100_000)
        self.word_ids = Pieces(self._word, 400_000)

    # -- encoding
    def _fragment(self, piece: bytes) -> bytes:
        """Ids of one fragment. Ids are the encoding exactly if each
        neighbouring pair encodes to itself; so take the longest token that
        fits behind the last one, and step back where none does."""
        if self.merged_by is not None:
            return array("I", self.merged_by(piece)).tobytes()
        n, fits, root, shorter = len(piece), self.pair_fits, self.trie, self.shorter
        if n > 4096:  # a run of one script or symbol; stepping is quadratic there at worst
            return array("I", self._merged(piece)).tobytes()
        ids: list[int] = []
        ends, at, dead, token = [], 0, set(), -1
        while at < n:
            if token < 0:  # the longest token from here
                node, k = root, at
                while k < n and (node := node.get(piece[k])) is not None:
                    k += 1
                    if (t := node.get(-1)) is not None:
                        token = t
            while True:
                end = at + self.length[token]
                if end not in dead and (not ids or fits[ids[-1], token]):
                    ids.append(token)
                    ends.append(at)
                    at, token = end, -1
                    break
                token = shorter[token]
                if token < 0:
                    dead.add(at)
                    token, at = ids.pop(), ends.pop()
        return array("I", ids).tobytes()

    def _merged(self, piece: bytes) -> list[int]:
        """Merges by lowest rank, leftmost first, by a heap over a linked list."""
        ids = [self.first[b] for b in piece]
        n, merge = len(ids), self.merge
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = []

        def push(k):
            if k >= 0 and right[k] < n and (m := merge.get((ids[k], ids[right[k]]))) is not None:
                heapq.heappush(heap, (m[0], k, ids[k], ids[right[k]], m[1]))

        for k in range(n - 1):
            push(k)
        while heap:
            _, k, a, b, made = heapq.heappop(heap)
            r = right[k]
            if ids[k] != a or r >= n or ids[r] != b:
                continue
            ids[k], ids[r], right[k] = made, -1, right[r]
            if right[r] < n:
                left[right[r]] = k
            push(left[k])
            push(k)
        return [i for i in ids if i >= 0]

    def _pair(self, pair: tuple[int, int]) -> bool:
        return self._merged(self.bytes_of[pair[0]] + self.bytes_of[pair[1]]) == list(pair)

    def _pretoken(self, raw: bytes) -> bytes:
        inside, start, out, last = self.inside, 0, [], raw[0]
        for k, b in enumerate(raw):
            if k and not inside[last * 256 + b]:
                out.append(self._fragment(raw[start:k]))
                start = k
            last = b
        if not out:
            return self._fragment(raw)
        out.append(self._fragment(raw[start:]))
        return b"".join(out)

    def _word(self, word: str) -> bytes:
        """Ids of a space and a word."""
        if word.isalpha():  # just the pattern's letters: one pre-token
            return self._pretoken(b" " + word.encode())
        if word[-1] in ".,!?;:)" and word[:-1].isalpha():
            return self.word_ids[word[:-1]] + self.token_ids[word[-1]]
        return self._chunk(" " + word)

    def _chunk(self, text: str) -> bytes:
        return b"".join([self.token_ids[t] if len(t) < 64 else self._pretoken(_raw(t)) for t in self.pattern.findall(text)])

    def _plain(self, text: str) -> bytes:
        """A text without special tokens. A single space before a visible
        character always starts a pre-token, so words are looked up whole;
        where white space follows a space, only the others are cut points."""
        if not text:
            return b""
        if self.merged_by is not None and longest_run(text) <= LIBRARY_RUN:
            return array("I", self.whole_by(text)).tobytes()
        words = text.split(" ") if not self.blank_run.search(text) and text[-1] != " " else self.unit.split(text)
        head = self._chunk(words[0]) if words[0] else b""
        known = self.word_ids
        return head + b"".join([known[w] if len(w) < 64 else self._chunk(" " + w) for w in words[1:]])

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        if self.special_re is None or not any(s in text for s in self.special):
            return self._plain(text)
        out, at = [], 0
        for m in self.special_re.finditer(text):
            out.append(self._plain(text[at : m.start()]))
            out.append(array("I", [self.special[m.group()]]).tobytes())
            at = m.end()
        out.append(self._plain(text[at:]))
        return b"".join(out)

    # -- decoding
    def decode(self, ids: bytes) -> str:
        return b"".join(map(self.bytes_of.__getitem__, array("I", ids))).decode("utf-8", "replace")


_MADE: dict[tuple[int, bool], ForcedCutBPE] = {}


def coder(spec: str, by_library: bool = False) -> ForcedCutBPE:
    """One coder per Python worker and vocabulary."""
    key = zlib.crc32(spec.encode()), by_library
    if key not in _MADE:
        _MADE.clear()
        _MADE[key] = ForcedCutBPE(spec, by_library)
    return _MADE[key]


def share_vocabulary(spark: SparkSession, path: str | None = None):
    """The vocabulary file as a broadcast (about 2 MB, whatever the data)."""
    with open(path or default_vocabulary(), encoding="utf-8") as f:
        return spark.sparkContext.broadcast(f.read())


def encode(docs: DataFrame, text: str = "text", vocabulary: str | None = None, ids_col: str = "ids") -> DataFrame:
    """Every column of ``docs`` and ``ids_col``: the ids of ``text``, an array
    of integers. A clashing column of that name is replaced."""
    prepare(docs.sparkSession)
    spec = share_vocabulary(docs.sparkSession, vocabulary)
    keep = [c for c in docs.columns if c != ids_col]

    def run(batches):
        import pyarrow as pa

        bpe = coder(spec.value)
        for batch in batches:
            ids = [np.frombuffer(bpe.encode(t), "<u4").astype(np.int32) for t in column(batch, text)]
            arrays = [batch.column(batch.schema.get_field_index(c)) for c in keep] + [pa.array(ids, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(arrays, names=[*keep, ids_col])

    from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

    schema = StructType([docs.schema[c] for c in keep] + [StructField(ids_col, ArrayType(IntegerType()))])
    return docs.mapInArrow(run, schema)


def decode(ids: DataFrame, ids_col: str = "ids", text: str = "text", vocabulary: str | None = None) -> DataFrame:
    """Every column of ``ids`` and ``text``: the text of the ids (null: empty)."""
    prepare(ids.sparkSession)
    spec = share_vocabulary(ids.sparkSession, vocabulary)
    keep = [c for c in ids.columns if c != text]

    def run(batches):
        import pyarrow as pa

        bpe = coder(spec.value)
        for batch in batches:
            texts = [bpe.decode(array("I", x or []).tobytes()) for x in column(batch, ids_col)]
            arrays = [batch.column(batch.schema.get_field_index(c)) for c in keep] + [pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, names=[*keep, text])

    from pyspark.sql.types import StringType, StructField, StructType

    schema = StructType([ids.schema[c] for c in keep] + [StructField(text, StringType())])
    return ids.mapInArrow(run, schema)


def round_trip(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """Per row: id count and digests of the ids and of the decoded text."""
    prepare(docs.sparkSession)
    spec = share_vocabulary(docs.sparkSession, vocabulary)

    def digest(batch):
        bpe = coder(spec.value)
        out = {"doc_id": column(batch, "doc_id"), "n_tokens": [], "ids_sha256": [], "decoded_sha256": []}
        for text in column(batch, "text"):
            ids = bpe.encode(text)
            out["n_tokens"].append(len(ids) // 4)
            out["ids_sha256"].append(hashlib.sha256(ids).hexdigest())
            out["decoded_sha256"].append(hashlib.sha256(bpe.decode(ids).encode()).hexdigest())
        return out

    return arrow_map(
        docs.select("doc_id", "text"), digest, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
