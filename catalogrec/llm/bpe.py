"""Byte-level BPE by recursive DuckDB queries inside Spark partitions.

A text is split by the vocabulary's pattern. A piece that is a token stands for itself; every other
distinct piece of a batch enters a recursive query as rows (piece, position, token). A step joins
neighbouring positions with the merge table (left token, right token, merged token), finds each
piece's lowest merged rank, contracts its leftmost occurrence and those further right that do not
overlap it, and goes on with the pieces that changed until none has a pair left. Equal pairs may be
contracted together because a merge of rank ``r`` only makes tokens that take part in merges of other
ranks; the leftmost of overlapping pairs wins, as in the sequential rule. Short pieces, which seldom
hold a pair twice, have one pair contracted in a step, which needs no runs of hits. Decoding joins the ids with
the token table and gathers the bytes in order of position.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import arrow_rows, texts

# Distinct pieces and rows of one recursive query, bytes of chunks and of merged pieces (text and ids) whose
# ids a worker keeps between batches (speed only: an id never depends on what is kept), and characters
# encoded at a time.
QUERY_PIECES = 16_384
KEPT_CHUNK_BYTES = 48 << 20
KEPT_PIECE_BYTES = 32 << 20
STEP_ROWS = 4_000_000
# Pieces of at most so many bytes have one pair contracted in a step.
SHORT_BYTES = 32
BATCH_CHARS = 2_000_000

_MERGE = """
with recursive steps(round, piece, pos, follows, token) as (
  select 0, piece, pos, follows, token from start
  union all
  select round, piece, pos, follows, token from (
    with pairs as (
      select a.piece, a.pos, b.pos as eaten, b.follows, m.merged
      from steps a
      join steps b on b.pos = a.follows
      join merges m on m.pair = a.token * 65536::bigint + b.token
      where a.round < $rounds
    ), best as (
      select piece, min(merged) as merged from pairs group by piece
    ), hits as (
      select p.* from pairs p join best using (piece, merged)
    ), runs as (
      -- Hits that overlap form a run; every other one is contracted, beginning with the first.
      select *, sum(case when before = pos then 0 else 1 end) over (order by pos) as run
      from (select *, lag(eaten) over (order by pos) as before from hits)
    ), chosen as (
      select * from runs qualify row_number() over (partition by run order by pos) % 2 = 1
    ), going as (
      select s.* from steps s semi join best b on s.piece = b.piece
    )
    select s.round + 1 as round, s.piece, s.pos, coalesce(c.follows, s.follows) as follows, coalesce(c.merged, s.token) as token
    from going s left join chosen c on s.pos = c.pos anti join chosen e on s.pos = e.eaten
  )
)
"""

_MERGE_SHORT = """
with recursive steps(round, piece, pos, follows, token) as (
  select 0, piece, pos, follows, token from start
  union all
  select round, piece, pos, follows, token from (
    with pairs as (
      -- Lowest rank first, then the leftmost: both in one number.
      select a.piece, m.merged * 4294967296::bigint + a.pos as place, b.pos as eaten, b.follows
      from steps a
      join steps b on b.pos = a.follows
      join merges m on m.pair = a.token * 65536::bigint + b.token
      where a.round < $rounds
    ), chosen as (
      select piece, min(place) % 4294967296 as pos, (min(place) // 4294967296)::int as merged,
        arg_min(eaten, place) as eaten, arg_min(follows, place) as follows
      from pairs group by piece
    )
    select s.round + 1 as round, s.piece, s.pos,
      case when s.pos = c.pos then c.follows else s.follows end as follows,
      case when s.pos = c.pos then c.merged else s.token end as token
    from steps s join chosen c on s.piece = c.piece where s.pos <> c.eaten
  )
)
"""

_ENDS = """, ends as (
  select piece, max(round) as round from steps group by piece
)
select piece, round, pos, token from steps join ends using (piece, round)
"""

_encoders: dict[tuple[str, str], Encoder] = {}



# Pieces cannot cross a lone space or line feed between other signs, so such a text falls into chunks
# that are encoded alike wherever they stand. Any other white space: the text is split as a whole.
def _words(value: str) -> list[str] | None:
    """The words of a text between lone spaces and line feeds, those behind a line feed with it in front;
    None if the text is empty or holds any other white space."""
    if not value or " ".join(value.split()) != value.replace("\n", " "):
        return None
    return value.replace("\n", " \n").split(" ")


class Encoder:
    """Token ids of texts; one per Python worker. Holds the vocabulary in an in-memory DuckDB."""

    def __init__(self, vocabulary: str, pattern: str) -> None:
        import duckdb

        with open(vocabulary, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}
        self.split = regex.compile(pattern).findall
        self.byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        # Ids of chunks and of merged pieces, as text: those of late, and those of before, which come back
        # when met again; a generation ends when its text and ids pass the byte bound.
        self.late: dict[str, str] = {}
        self.before: dict[str, str] = {}
        self.late_bytes = 0
        self.merged_late: dict[str, str] = {}
        self.merged_before: dict[str, str] = {}
        self.merged_bytes = 0
        pairs, merged = [], []
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                left, right = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs.append(left * 65536 + right)
                    merged.append(rank)
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "400MB"})
        self._table("merges", {"pair": pa.array(pairs, pa.int64()), "merged": pa.array(merged, pa.int32())})
        known = {"token": pa.array(list(self.ranks.values()), pa.int32()), "bytes": pa.array(list(self.ranks), pa.binary())}
        self._table("tokens", known)

    def _table(self, name: str, columns: dict) -> None:
        self.db.register("given", pa.table(columns))
        self.db.execute(f"create table {name} as select * from given")
        self.db.unregister("given")

    def _merge(self, pieces: list[str]) -> list[str]:
        """Ids of distinct pieces that are no tokens themselves.

        The query keeps the rows of all its steps, so the number of steps is bounded by their number;
        pieces that need more (words of hundreds of letters) go on from where they are.
        """
        done = [""] * len(pieces)
        coded = [p.encode() for p in pieces]
        lengths = np.fromiter(map(len, coded), np.int64, len(coded))
        tokens = self.byte_ids[np.frombuffer(b"".join(coded), np.uint8)]
        short = lengths <= SHORT_BYTES
        for query, of in ((_MERGE_SHORT, short), (_MERGE, ~short)):
            left, sizes, given = np.flatnonzero(of).tolist(), lengths[of], tokens[np.repeat(of, lengths)]
            while left:
                left, sizes, given = self._steps(query, left, sizes, given, done)
        return done

    def _steps(
        self, query: str, left: list[int], lengths: np.ndarray, tokens: np.ndarray, done: list[str]
    ) -> tuple[list[int], np.ndarray, np.ndarray]:
        """Merge the pieces ``left``, whose tokens lie behind each other, as far as one query goes.

        Returns the pieces that are not done, the number of tokens of each, and these tokens.
        """
        ends = np.cumsum(lengths)
        total = int(ends[-1])
        follows = np.arange(1, total + 1, dtype=np.int32)
        follows[ends - 1] = -1
        start = pa.table(
            {
                "piece": np.repeat(np.arange(len(left), dtype=np.int32), lengths),
                "pos": np.arange(total, dtype=np.int32),
                "follows": follows,
                "token": tokens,
            }
        )
        rounds = max(8, STEP_ROWS // total)
        self.db.register("start", start)
        found = self.db.sql(query.replace("$rounds", str(rounds)) + _ENDS).to_arrow_table()
        self.db.unregister("start")
        # Positions ascend over the pieces, so their order is that of the pieces too.
        order = np.argsort(found["pos"].to_numpy())
        piece, token = found["piece"].to_numpy()[order], found["token"].to_numpy()[order]
        at = found["round"].to_numpy()[order]
        coded = list(map(str, token.tolist()))
        bounds = np.searchsorted(piece, np.arange(len(left) + 1))
        more = at[bounds[:-1]] >= rounds
        sizes = np.diff(bounds)
        for i, a, b, unfinished in zip(left, bounds[:-1].tolist(), bounds[1:].tolist(), more.tolist(), strict=True):
            if not unfinished:
                done[i] = ",".join(coded[a:b])
        again = [left[i] for i in np.flatnonzero(more).tolist()]
        return again, sizes[more], token[np.repeat(more, sizes)].astype(np.int32)

    def _pieces(self, wanted: set[str]) -> dict[str, str]:
        """Ids of distinct pieces, as text."""
        known, missing = {}, []
        for piece in wanted:
            rank = self.ranks.get(piece.encode())
            if rank is not None:
                known[piece] = str(rank)
            elif piece in self.merged_late:
                known[piece] = self.merged_late[piece]
            elif piece in self.merged_before:
                known[piece] = self._keep_merged(piece, self.merged_before[piece])
            else:
                missing.append(piece)
        missing.sort(key=len)
        begin = size = 0
        for at, piece in enumerate(missing):
            size += len(piece)
            if at > begin and (at - begin >= QUERY_PIECES or size > 16 * QUERY_PIECES):
                for p, ids in zip(missing[begin:at], self._merge(missing[begin:at]), strict=True):
                    known[p] = self._keep_merged(p, ids)
                begin, size = at, len(piece)
        if missing:
            for p, ids in zip(missing[begin:], self._merge(missing[begin:]), strict=True):
                known[p] = self._keep_merged(p, ids)
        return known

    def _keep_merged(self, piece: str, ids: str) -> str:
        """Keep the ids of a merged piece in the late generation; a full generation becomes the one before."""
        if self.merged_bytes > KEPT_PIECE_BYTES:
            self.merged_before, self.merged_late, self.merged_bytes = self.merged_late, {}, 0
        self.merged_late[piece] = ids
        self.merged_bytes += len(piece) + len(ids) + 100
        return ids

    def _learn(self, chunks: set[str]) -> None:
        """Take up the ids of chunks; beyond ``KEPT_CHUNK_BYTES`` those not met of late are forgotten."""
        split, wanted = {}, set()
        for chunk in chunks:
            if chunk in self.before:
                self.late[chunk] = self.before[chunk]
                self.late_bytes += len(chunk) + len(self.before[chunk]) + 100
            else:
                split[chunk] = parts = self.split(chunk)
                wanted.update(parts)
        ids = self._pieces(wanted)
        for chunk, parts in split.items():
            self.late[chunk] = coded = ",".join([ids[p] for p in parts])
            self.late_bytes += len(chunk) + len(coded) + 100

    def encode(self, values: list[str]) -> list[str]:
        """Ids of each text as decimal numbers joined by commas."""
        if self.late_bytes > KEPT_CHUNK_BYTES:
            self.before, self.late, self.late_bytes = self.late, {}, 0
        chunked = []
        for value in values:
            words = _words(value)
            if words is None:
                chunked.append(self.split(value))
            else:
                # Chunks begin with their space or line feed, but for the first.
                chunked.append([words[0], *[w if w[0] == "\n" else " " + w for w in words[1:]]])
        known = [list(map(self.late.get, chunks)) for chunks in chunked]
        self._learn({c for chunks, got in zip(chunked, known) if None in got for c, ids in zip(chunks, got) if ids is None})
        late = self.late
        return [
            ",".join([late[c] if ids is None else ids for c, ids in zip(chunks, got)] if None in got else got)
            for chunks, got in zip(chunked, known)
        ]

    def decode(self, ids: list[np.ndarray]) -> list[bytes]:
        """Bytes of each text: its ids meet the token table and the bytes are put in order of position."""
        coded = pa.table({"pos": np.arange(sum(map(len, ids)), dtype=np.int32), "token": np.concatenate(ids)})
        self.db.register("coded", coded)
        ordered = self.db.sql("select t.bytes from coded c join tokens t using (token) order by c.pos").to_arrow_table()
        self.db.unregister("coded")
        # The bytes of an Arrow column lie behind each other already; only the bounds are needed.
        parts = pa.concat_arrays([c.cast(pa.large_binary()) for c in ordered["bytes"].chunks] or [pa.array([], pa.large_binary())])
        bounds = np.frombuffer(parts.buffers()[1], np.int64)[parts.offset : parts.offset + len(parts) + 1] if len(parts) else np.zeros(1, np.int64)
        joined = parts.buffers()[2].to_pybytes() if len(parts) else b""
        ends = bounds[np.cumsum([0, *map(len, ids)])]
        return [joined[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]


def bpe_encode(
    df: DataFrame, vocabulary: str, pattern: str, text: str = "text", keep: list[str] | None = None, ids: bool = False
) -> DataFrame:
    """Add ``n_tokens``, ``ids_sha256`` and ``decoded_sha256`` to every row, and ``token_ids`` if ``ids``.

    The whole text is encoded; null counts as the empty text (no tokens, digests of the empty string).
    ``vocabulary`` is a file of base64 tokens and ranks which every executor can read.
    Rows stay where they are: no shuffle, and a task holds one Arrow batch, a bounded table of known
    chunks and one bounded query. Empty tables, ties, repeated rows and other columns need no rule.
    """

    def compute(batch: pa.RecordBatch) -> dict:
        encoder = _encoders.get((vocabulary, pattern))
        if encoder is None:
            encoder = _encoders[vocabulary, pattern] = Encoder(vocabulary, pattern)
        values = texts(batch.column(text))
        made: dict[str, list] = {"n_tokens": [], "ids_sha256": [], "decoded_sha256": [], "token_ids": []}
        begin = 0
        while begin < len(values):
            end, size = begin, 0
            while end < len(values) and (end == begin or size + len(values[end]) <= BATCH_CHARS):
                size += len(values[end])
                end += 1
            coded = encoder.encode(values[begin:end])
            numbers = [np.fromstring(c, np.int32, sep=",") if c else np.zeros(0, np.int32) for c in coded]
            decoded = encoder.decode(numbers)
            made["n_tokens"] += [len(n) for n in numbers]
            made["ids_sha256"] += [hashlib.sha256(c.encode()).hexdigest() for c in coded]
            made["decoded_sha256"] += [hashlib.sha256(d).hexdigest() for d in decoded]
            if ids:
                made["token_ids"] += numbers
            begin = end
        if ids:  # plain Python numbers would take many times the room
            ends = np.cumsum([0, *map(len, made["token_ids"])]).astype(np.int32)
            flat = np.concatenate([np.zeros(0, np.int32), *made["token_ids"]])
            made["token_ids"] = pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))
        return made

    columns = "n_tokens long, ids_sha256 string, decoded_sha256 string" + (", token_ids array<int>" if ids else "")
    new = {"n_tokens", "ids_sha256", "decoded_sha256", "token_ids"}
    keep = [c for c in (df.columns if keep is None else keep) if c not in new]
    return arrow_rows(df.select(*dict.fromkeys([*keep, text])), compute, columns, keep)
