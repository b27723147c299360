"""Chat formatting by token-level assembly.

Each segment (a role, a text) is encoded by itself, so no token crosses a border. Reserved ids, which
no text can yield, are spliced between segments; the loss mask comes from prefix sums of the segment
lengths. In the decoded form the reserved ids read as ``### ``, ``: `` and `` </turn>`` and a line
end; the same strings inside a role or text get a backslash in front, and backslashes are doubled,
so a backslash followed by any character always stands for that character.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import itertools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .scratch import table
from .token_counts import small_batches

CONTROL = ("###", "</turn>")
TO_ESCAPE = re.compile(r"\\|" + "|".join(f"{re.escape(c[0])}(?={re.escape(c[1:])})" for c in CONTROL))
ESCAPED = re.compile(r"\\(.)", re.S)
#: Reserved ids follow the file's ranks, 50,256 of them, and the id that the file leaves free.
OPEN, MIDDLE, CLOSE = 50257, 50258, 50259
READS = {OPEN: "### ", MIDDLE: ": ", CLOSE: " </turn>\n"}


def escape(text: str) -> str:
    return TO_ESCAPE.sub(lambda m: "\\" + m.group(), text)


def unescape(text: str) -> str:
    return ESCAPED.sub(r"\1", text)


@functools.lru_cache(maxsize=2)
def encoding(path: str, pattern: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    if max(ranks.values()) >= OPEN:
        raise ValueError(f"{path}: reserved ids are taken")
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def assemble(enc, role: str, text: str, trained: bool) -> tuple[np.ndarray, np.ndarray]:
    """Ids of one turn, and its mask: 1 at the ids of a trained text, 0 elsewhere."""
    segments = [[OPEN], enc.encode_ordinary(escape(role)), [MIDDLE], enc.encode_ordinary(escape(text)), [CLOSE]]
    ends = np.cumsum([len(s) for s in segments])
    steps = np.zeros(ends[-1] + 1, np.int8)
    if trained:
        steps[ends[2]] += 1
        steps[ends[3]] -= 1
    return np.array(list(itertools.chain(*segments)), np.uint32), np.cumsum(steps[:-1], dtype=np.int8).astype(np.uint8)


def read_turn(enc, ids: np.ndarray, mask: np.ndarray) -> tuple[str, str, str, int]:
    """From ids and mask alone: role, text, text under the mask, characters of the decoded turn."""
    middle = int(np.flatnonzero(ids == MIDDLE)[0])
    if ids[0] != OPEN or ids[-1] != CLOSE:
        raise ValueError("not a turn")
    decode = lambda x: enc.decode_bytes(x.tolist()).decode("utf-8")
    role, text, under = decode(ids[1:middle]), decode(ids[middle + 1 : -1]), decode(ids[mask == 1])
    return unescape(role), unescape(text), unescape(under), len(role) + len(text) + sum(map(len, READS.values()))


def format_turns(turns: DataFrame, path: str, pattern: str, trained_role: str = "assistant") -> DataFrame:
    """conv_id, turn, role, text of each row, with ids (little-endian uint32) and mask (a byte an id).

    Null roles and texts are empty ones; other columns go. Repeated rows give a row each, and an empty
    table none. Rows stay where they are: a conversation of any length needs no more memory than a turn.
    """
    small_batches(turns.sparkSession)
    rows = turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    types = pa.schema([("conv_id", pa.int64()), ("turn", pa.int64()), ("role", pa.string()), ("text", pa.string()), ("ids", pa.binary()), ("mask", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoding(path, pattern)
        for b in batches:
            made = [assemble(enc, r or "", t or "", r == trained_role) for r, t in zip(b["role"].to_pylist(), b["text"].to_pylist())]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([i.tobytes() for i, _ in made], pa.binary()), pa.array([m.tobytes() for _, m in made], pa.binary())], schema=types)

    return rows.mapInArrow(run, "conv_id long, turn long, role string, text string, ids binary, mask binary")


def digests(formatted: DataFrame, path: str, pattern: str) -> DataFrame:
    """One row a conversation, read back from ids and masks in order of turn, role and text, nulls first.

    Rows with a null conv_id are a conversation of their own; repeated rows count each time.

    SHA-256 takes its input in order, so a conversation's rows pass through one task; they stream
    from Spark's sort, which spills, and only the running hash is held.
    """
    types = pa.schema([("conv_id", pa.int64()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, now, out = encoding(path, pattern), None, []
        for b in batches:
            for conv, ids, mask in zip(*(b[c].to_pylist() for c in ("conv_id", "ids", "mask"))):
                if now is None or now[0] != conv:
                    if now is not None:
                        out.append(now)
                    now = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                role, text, under, chars = read_turn(enc, np.frombuffer(ids, np.uint32), np.frombuffer(mask, np.uint8))
                now[1] += 1
                now[2].update(f"{role}\n{text}\n".encode())
                now[3] += len(under)
                now[4].update(under.encode())
                now[5] += chars
            if len(out) > 1000:
                yield pack(out)
                out = []
        yield pack(out + [now] * (now is not None))

    def pack(rows: list) -> pa.RecordBatch:
        cols = list(zip(*[(c, n, a.hexdigest(), k, d.hexdigest(), f) for c, n, a, k, d, f in rows])) or [[]] * 6
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, types.types)], schema=types)

    rows = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "ids", "mask")
    return rows.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def query(spark, sf_dir) -> DataFrame:
    import public_tokenizers as P

    said = r"\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    path = P.path("byte_bpe_50k.tiktoken")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return digests(format_turns(turns, path, P.PATTERN), path, P.PATTERN)


SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations
  UNION ALL SELECT * FROM (VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok'))),
e AS (SELECT *, 15 + length(r) + length(x) + list_sum(list_transform([r, x], lambda s:
        length(s) - length(replace(s, '\', '')) + (length(s) - length(replace(s, '</turn>', ''))) // 7
        + coalesce(list_sum(list_transform(regexp_extract_all(s, '#{3,}'), lambda h: length(h) - 2)), 0))) AS f FROM t)
SELECT CAST(conv_id AS BIGINT) AS conv_id, count(*) AS n_turns,
       sha256(string_agg(r || chr(10) || x || chr(10), '' ORDER BY turn NULLS FIRST, r, x)) AS turns_sha256,
       CAST(coalesce(sum(length(x)) FILTER (r = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(x, '' ORDER BY turn NULLS FIRST, r, x) FILTER (r = 'assistant'), '')) AS loss_sha256,
       CAST(sum(f) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""
