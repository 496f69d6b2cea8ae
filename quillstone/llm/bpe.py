"""Byte-level BPE with DuckDB's recursive queries.

Every partition splits its texts with the vocabulary's pattern and keeps the distinct words it has
not met.  One recursive query encodes a batch of them: a word's tokens are unnested to a row for each
position, joined to the merge table with their right neighbours; each step contracts every word's
leftmost pair of minimum rank, and a word leaves the recursion when no pair of its is left.  Ordered
aggregation gives a word's ids and, from the ids, its bytes again.

The recursion is keyed by word, so that it holds one state of each word and only those that changed in
a step go on.  In a state a token is one character (BASE and its id).  A step contracts all places of
the leftmost pair of minimum rank at once, as one by one would do, unless one place can stand in the way
of the next: the new token would go before with the next one's first (alone), or another pair of the same rank,
somewhere in the word, can share a token with this one (meets).  If a pair of lower rank turns up after it, the
step is taken back and only its leftmost place contracted.  So a run of one character takes steps by the logarithm of its length.

A word is cut before the query where no token of the vocabulary that stands in it reaches across: no
contraction ever joins both sides there, so the pieces' tokens are the word's.  Long unspaced texts fall into
short pieces by this.  What a piece's ids decode to is compared with the piece.  Batches hold BATCH_BYTES of pieces, or one longer piece, for which the query's
memory is raised in proportion.

Words that are whole tokens take the token, as the public library does.  Results for words are kept
between batches in two generations of bounded size, so memory doesn't follow the vocabulary of the
corpus; those of words over KEPT_LENGTH bytes are only kept for their batch.

Defined results: null text counts as empty and gives no ids, the digest of nothing, and empty bytes;
very long texts and words are encoded whole; lone surrogates can't occur in Spark strings; repeated rows
give repeated rows; an empty table gives none; other columns of the input, whatever their names, are
not looked at.
"""

from __future__ import annotations

import base64
import gc
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import take_over, text_or_empty

#: Texts are encoded in groups of about so many characters.
GROUP_CHARS = 1_500_000
AWKWARD = re.compile(r" \s| $").search
#: Bytes encoded by one recursive query, and words kept in each of two generations.
BATCH_BYTES, KEPT_WORDS = 300_000, 400_000
#: Longer words are looked through for places to cut, and still longer ones forgotten after their batch.
CUT_LENGTH, KEPT_LENGTH = 32, 1024
#: Memory of a query, and what each byte of a batch beyond BATCH_BYTES adds to it.
QUERY_MB, MORE_BYTES = 250, 1000
#: The character of token id is BASE + id: no combining ones and no surrogates from here on.
BASE = 0x20000
LAST = 2**31

STEP = f"""
with recursive state(w, s, last, before, place) using key (w) as (
    select w, s, -1, '', 0 from start
    union all
    select
        w, case
            when rank < last then left(before, place) || chr(last + {BASE}) || substr(before, place + 3)
            when single then left(s, spot) || chr(rank + {BASE}) || substr(s, spot + 3)
            else replace(s, substr(s, spot + 1, 2), chr(rank + {BASE})) end,
        case when rank < last or single then -1 else rank end, s, spot::int
    from (
        select *, flags = 1 or flags = 2 and low & 4294967295 <> {LAST} - (high & 4294967295) as single
        from state join (
            select
                a.w, min(m.key | a.spot) as best, (best >> 34)::int as rank, best & {LAST} - 1 as spot, best >> 32 & 3 as flags, min(m.low) as low, min(m.high) as high
            from (
                select w, unnest(c[:-2]) || unnest(c[2:]) as pair, unnest(range(len(c) - 1)) as spot
                from (select w, string_split(s, '') as c from state)
            ) a join merges m on m.pair = a.pair
            group by a.w
        ) using (w)
    )
),
positions as (select w, unnest(string_split(s, '')) as t, unnest(range(length(s))) as p from state)
select w, encode(string_agg(id, ',')) as ids, unhex(string_agg(hex, '')) as decoded
from (select w, id, hex from positions join vocabulary on token = t order by w, p)
group by w
"""


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


class Encoder:
    """Ids and decoded bytes of words, by a DuckDB connection of its own."""

    def __init__(self, path: str, pattern: str) -> None:
        import ahocorasick
        import duckdb
        import regex

        self.ranks = load_ranks(path)
        self.tokens = {r: t for t, r in self.ranks.items()}
        #: The UTF-8 bytes of each byte's character, four each.
        self.start = np.array([list(chr(BASE + self.ranks[bytes([b])]).encode()) for b in range(256)], np.uint8)
        self.split = regex.compile(pattern).findall
        self.within = ahocorasick.Automaton()
        for token in self.ranks:
            if len(token) > 1:
                self.within.add_word(token.decode("latin-1"), len(token))
        self.within.make_automaton()
        self.db = duckdb.connect(config={"threads": 1})
        self.db.execute("set temp_directory=''")
        pair, rank, flags = [], [], []
        for token, r in self.ranks.items():
            parts = [(token[:i], token[i:]) for i in range(1, len(token)) if token[:i] in self.ranks and token[i:] in self.ranks]
            for a, b in parts:
                pair.append(chr(BASE + self.ranks[a]) + chr(BASE + self.ranks[b]))
                rank.append(r)
                alone, meets = self.ranks.get(token + a, r) < r, any((x, y) != (a, b) and (y == a or x == b) for x, y in parts)
                flags.append(1 if alone else 2 if meets else 0)
        ids, rank = np.arange(len(pair)), np.array(rank, np.int64)
        self._table("merges", pair=pa.array(pair), key=rank << 34 | np.array(flags, np.int64) << 32, low=rank << 32 | ids, high=rank << 32 | LAST - ids)
        self._table("vocabulary", token=pa.array([chr(BASE + r) for r in self.tokens]), id=pa.array(list(map(str, self.tokens))), hex=pa.array([t.hex() for t in self.tokens.values()]))
        #: Ids and decoded bytes of words, of this generation and the last one.
        self.ids: dict[str, bytes] = {}
        self.raw: dict[str, bytes] = {}
        self.old: tuple[dict[str, bytes], dict[str, bytes]] = ({}, {})

    def _table(self, name: str, **columns: pa.Array) -> None:
        given = pa.table(columns)  # noqa: F841  found by name
        self.db.execute(f"create or replace table {name} as select * from given")

    def pieces(self, raw: bytes) -> list[bytes]:
        """raw cut wherever no token that stands in it reaches across."""
        found = np.array([(end, n) for end, n in self.within.iter(raw.decode("latin-1"))], np.int64).reshape(-1, 2)
        # A token in [i, j] reaches across the places i+1..j; place k stands before byte k.
        size = len(raw) + 2
        change = np.bincount(found[:, 0] - found[:, 1] + 2, minlength=size) - np.bincount(found[:, 0] + 1, minlength=size)
        free = np.flatnonzero(np.cumsum(change)[1 : len(raw)] == 0) + 1
        ends = [0, *free.tolist(), len(raw)]
        return [raw[a:b] for a, b in zip(ends, ends[1:])]

    def learn(self, words: list[str]) -> None:
        """Encodes words that are not known and keeps the results."""
        whole: dict[bytes, str] = {}
        cut: dict[str, list[bytes]] = {}
        for word in words:
            raw = word.encode()
            if (r := self.ranks.get(raw)) is not None:
                self.ids[word], self.raw[word] = b"%d" % r, self.tokens[r]
            elif len(raw) <= CUT_LENGTH:
                whole[raw] = word
            else:
                cut[word] = self.pieces(raw)
        done: dict[bytes, bytes] = {}
        batch, size = [], 0
        for piece in [*whole, *{x for xs in cut.values() for x in xs if x not in whole}]:
            if batch and size + len(piece) > BATCH_BYTES:
                done.update(self._query(batch))
                batch, size = [], 0
            batch.append(piece)
            size += len(piece)
        if batch:
            done.update(self._query(batch))
        for word, xs in cut.items():
            self.ids[word], self.raw[word] = b",".join([done[x] for x in xs]), b"".join(xs)
        for raw, word in whole.items():
            self.ids[word], self.raw[word] = done[raw], raw

    def _query(self, pieces: list[bytes]) -> Iterator[tuple[bytes, bytes]]:
        """What each piece's ids decode to, which is the piece, and the ids."""
        joined = b"".join(pieces)
        self.db.execute(f"set memory_limit='{QUERY_MB + max(0, len(joined) - BATCH_BYTES) * MORE_BYTES // 1_000_000}MB'")
        ends = np.zeros(len(pieces) + 1, np.int64)
        np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces)), out=ends[1:])
        signs = self.start[np.frombuffer(joined, np.uint8)]
        s = pa.LargeStringArray.from_buffers(len(pieces), pa.py_buffer(ends * self.start.shape[1]), pa.py_buffer(signs))
        start = pa.table({"w": pa.array(range(len(pieces)), pa.int32()), "s": s})  # noqa: F841  found by name
        out = self.db.sql(STEP).to_arrow_table()
        decoded = out.column("decoded").to_pylist()
        if len(decoded) != len(pieces) or decoded != [pieces[w] for w in out.column("w").to_pylist()]:
            raise ValueError("words came back as others")
        return zip(decoded, out.column("ids").to_pylist())

    def _missing(self, words: set[str]) -> list[str]:
        """Those of words with no result yet; results of the older generation are taken over."""
        missing, (ids, raw) = [], self.old
        for word in words - self.ids.keys():
            if word in ids:
                self.ids[word], self.raw[word] = ids[word], raw[word]
            else:
                missing.append(word)
        return missing

    def words_of(self, piece: str) -> list[str]:
        """The pattern's words of a piece without white space but for one space before it."""
        body = piece[1:] if piece[0] == " " else piece
        if body.isalpha():
            return [piece]
        if body[-1:] in (",", ".", "!", "?", ";", ":") and body[:-1].isalpha():
            return [piece[:-1], piece[-1]]
        return self.split(piece)

    def encode(self, texts: list[str]) -> list[tuple[int, bytes, bytes]]:
        """n_tokens, ids joined by commas, decoded bytes for each text.

        Where no space stands before other white space, splitting at spaces first can't change the
        pattern's words: each piece, with its space, is split by itself and looked up whole.
        """
        if len(self.ids) > KEPT_WORDS:
            self.old, self.ids, self.raw = (self.ids, self.raw), {}, {}
        pieces = []
        for text in texts:
            if AWKWARD(text):
                pieces.append(self.split(text))
            else:
                parts = text.replace(" ", "\0 ").split("\0") if "\0" not in text else re.split("(?= )", text)
                pieces.append(parts if parts[0] else parts[1:])
        missing = self._missing(set().union(*pieces))
        several = {}
        for x in missing:
            if len(ws := self.words_of(x)) > 1:
                several[x] = ws
        self.learn([x for x in missing if x not in several] + self._missing({w for ws in several.values() for w in ws}.difference(missing)))
        of_id, of_raw = self.ids.__getitem__, self.raw.__getitem__
        for x, ws in several.items():
            self.ids[x], self.raw[x] = b",".join(map(of_id, ws)), b"".join(map(of_raw, ws))
        out = []
        for ws in pieces:
            ids = b",".join(map(of_id, ws))
            out.append((ids.count(b",") + bool(ids), ids, b"".join(map(of_raw, ws))))
        for x in [x for x in (*missing, *(w for ws in several.values() for w in ws)) if len(x) > KEPT_LENGTH]:
            self.ids.pop(x, None), self.raw.pop(x, None)
        return out


_ENCODERS: dict[tuple[str, str], Encoder] = {}


def encoder(path: str, pattern: str) -> Encoder:
    """One for each Python worker, path and pattern; the files must be on every executor at path."""
    if (path, pattern) not in _ENCODERS:
        _ENCODERS[path, pattern] = Encoder(path, pattern)
    return _ENCODERS[path, pattern]


def forget() -> None:
    for e in _ENCODERS.values():
        e.db.close()
    _ENCODERS.clear()


def groups(texts: list[str], most: int = GROUP_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about most characters each."""
    begin = size = 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= most:
            yield begin, i + 1
            begin, size = i + 1, 0
    if begin < len(texts):
        yield begin, len(texts)


def encode_documents(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", ids: bool = True, keep: tuple[Column, ...] = ()) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, with ids the token ids themselves, and keep's columns, for every row of docs."""
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"), *keep)
    schema = T._parse_datatype_string("doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + (", ids array<int>" if ids else ""))
    kept = slim.columns[2:]
    schema = T.StructType([*schema.fields, *(slim.schema[c] for c in kept)])

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(path, pattern)
        for batch in batches:
            doc_ids, column = batch.column("doc_id"), batch.column("text")
            lengths = column.nbytes
            step = max(1, batch.num_rows * GROUP_CHARS // max(lengths, 1))
            for i in range(0, batch.num_rows, step):
                texts = column.slice(i, step).to_pylist()
                for a, b in groups(texts):
                    rows = e.encode(texts[a:b])
                    columns = [
                        doc_ids.slice(i + a, b - a), pa.array([n for n, _, _ in rows], pa.int64()),
                        pa.array([hashlib.sha256(x).hexdigest() for _, x, _ in rows]), pa.array([hashlib.sha256(x).hexdigest() for _, _, x in rows]),
                    ]
                    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                    if ids:
                        columns.append(pa.array([list(map(int, x.split(b","))) if x else [] for _, x, _ in rows], pa.list_(pa.int32())))
                        names.append("ids")
                    columns += [batch.column(c).slice(i + a, b - a) for c in kept]
                    names += kept
                    yield pa.RecordBatch.from_arrays(columns, names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        take_over("bpe", forget)
        collects = gc.isenabled()
        gc.disable()  # hundreds of thousands of small results and no cycles among them
        try:
            yield from encoded(batches)
        finally:
            if collects:
                gc.enable()

    return slim.mapInArrow(run, schema)
