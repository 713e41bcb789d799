"""Byte-level BPE encoding and decoding with an Aho-Corasick automaton.

The vocabulary's tokens, with bytes mapped to Latin-1 characters, form one automaton; it gives
the longest token that ends at each byte. A piece of text is encoded from its end towards its
front: the best segmentation of a prefix ends in the longest token that is compatible with the
token before it. Two adjacent tokens are compatible if BPE, run over their bytes together, would
leave exactly these two. That test is memoised, so encoding takes time in proportion to the text
for a bounded token length, and equals the merges by rank.

Pieces are the matches of a pattern and are encoded separately; a bounded memo keeps what the
most recent distinct pieces became. Ids are returned as little-endian unsigned 32-bit integers.

A null or empty text has no ids. Texts of any length are handled whole. Repeated rows are encoded
each for itself; further columns are left alone, whatever their names.
"""

from __future__ import annotations

import base64
import hashlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from maskwright.llm.common import release

#: Most pieces and pairs of tokens that a worker remembers; a full memo starts anew.
MEMO_PIECES = 400_000
MEMO_PAIRS = 400_000
SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def load_ranks(content: bytes) -> dict[bytes, int]:
    """Ranks from the text of a rank file: a base64 token and its rank on each line."""
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in content.splitlines() if line.strip())}


class BytePairCodec:
    """Encoder and decoder for one vocabulary of ranks."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import ahocorasick
        import regex

        self.ranks = ranks
        self.tokens = {r: t for t, r in ranks.items()}
        self.length = {r: len(t) for t, r in ranks.items()}
        self.longest = ahocorasick.Automaton()
        for token, r in ranks.items():
            self.longest.add_word(token.decode("latin-1"), r)
        self.longest.make_automaton()
        # the two tokens whose merge makes a token, None for bytes
        self.parts = {r: self._parts(t) for t, r in ranks.items()}
        self.merged = {p: r for r, p in self.parts.items() if p}
        # a token that merges can't reach makes the automaton's way inexact
        self.exact = all(self.parts[r] for t, r in ranks.items() if len(t) > 1) and all(bytes([b]) in ranks for b in range(256))
        self.shorter = {r: next((ranks[t[i:]] for i in range(1, len(t)) if t[i:] in ranks), -1) for t, r in ranks.items()}
        self.pairs: dict[int, bool] = {}
        self.find = regex.compile(pattern).findall
        self.memo = _Memo(self)

    def _parts(self, token: bytes) -> tuple[int, int] | None:
        ids = self.merge(token, self.ranks[token]) if len(token) > 1 else []
        return (ids[0], ids[1]) if len(ids) == 2 else None

    def _compatible(self, left: int, right: int) -> bool:
        """Whether BPE over the bytes of left and right together leaves these two tokens.

        Takes the merges that made the two tokens back, the latest first; the tokens then at the
        border must not have a merge that would have come before the one just taken back. Of
        equal merges the left one comes first.
        """
        parts, merged = self.parts, self.merged
        due = 1 << 60
        while True:
            if merged.get((left, right), due) < due:
                return False
            a, b = parts[left], parts[right]
            if a is None and b is None:
                return True
            if b is None or a is not None and left > right:
                due, left = left, a[1]
            else:
                due, right = right + 1, b[0]

    def encode_piece(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        if not self.exact:
            return self.merge(piece)
        length, shorter, pairs = self.length, self.shorter, self.pairs
        last = []  # the last token of the encoding of each prefix
        start = len(piece)
        found = [-1] * start
        for i, r in self.longest.iter(piece.decode("latin-1")):
            if found[i] < 0 or length[r] > length[found[i]]:
                found[i] = r
        for i, r in enumerate(found):
            while True:
                before = i - length[r]
                if before < 0:
                    break
                key = last[before] << 32 | r
                fits = pairs.get(key)
                if fits is None:
                    if len(pairs) >= MEMO_PAIRS:
                        pairs.clear()
                    fits = pairs[key] = self._compatible(last[before], r)
                if fits:
                    break
                r = shorter[r]
            last.append(r)
        out, i = [], start - 1
        while i >= 0:
            out.append(last[i])
            i -= length[last[i]]
        return out[::-1]

    def merge(self, piece: bytes, below: int = 1 << 60) -> list[int]:
        """The plain merges by rank, using ranks below the given one only."""
        pieces = [piece[i : i + 1] for i in range(len(piece))]
        while len(pieces) > 1:
            rank, i = min((self.ranks.get(pieces[i] + pieces[i + 1], 1 << 60), i) for i in range(len(pieces) - 1))
            if rank >= below:
                break
            pieces[i : i + 2] = [pieces[i] + pieces[i + 1]]
        return [self.ranks[p] for p in pieces]

    def encode(self, text: str) -> bytes:
        """The ids of a text, as little-endian unsigned 32-bit integers."""
        return b"".join(map(self.memo.__getitem__, self.find(text)))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, memoryview(ids).cast("I").tolist()))


class _Memo(dict):
    def __init__(self, codec: BytePairCodec):
        super().__init__()
        self.codec = codec

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= MEMO_PIECES:
            self.clear()
        ids = array("I", self.codec.encode_piece(piece.encode("utf-8"))).tobytes()
        if len(piece) <= 64:
            self[piece] = ids
        return ids


_codecs: dict[tuple[str, str], BytePairCodec] = {}


def codec(content: bytes, pattern: str) -> BytePairCodec:
    """The codec of a rank file's content; each Python worker builds it once."""
    key = (hashlib.md5(content).hexdigest(), pattern)
    if key not in _codecs:
        _codecs[key] = BytePairCodec(load_ranks(content), pattern)
    return _codecs[key]


def encode_decode(docs: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """Per row: id, n_tokens, the digests of ids and of the decoded bytes, and the ids if asked for.

    The rank file is read by the driver and sent to the executors once (it is under 1 MB for a
    vocabulary of 50,000 tokens, whatever the size of the table).
    """
    with open(rank_file, "rb") as f:
        shared = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches):
        tool = codec(shared.value, pattern)
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            n, digest, back, raw = [], [], [], []
            for text in texts:
                enc = tool.encode(text.as_py() or "")
                n.append(len(enc) // 4)
                digest.append(hashlib.sha256(enc).hexdigest())
                back.append(hashlib.sha256(tool.decode(enc)).hexdigest())
                raw.append(np.frombuffer(enc, np.int32) if keep_ids else None)
            columns = [ids, pa.array(n, pa.int64()), pa.array(digest, pa.string()), pa.array(back, pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if keep_ids:
                columns.append(pa.array(raw, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)
        tool.memo.clear()  # the next task's texts are others; pairs of tokens recur
        release()

    return docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text")).mapInArrow(run, SCHEMA + (", ids array<int>" if keep_ids else ""))
