"""Removal of repeated byte strings with sorted suffixes.

Method: distributed merge sort of suffixes that knows common prefixes. Groups
of documents sort their suffixes and send them as front-coded runs (length of
the prefix shared with the entry before, then the rest). A receiver merges runs
with a loser tree: an entry carries the prefix it is known to share with the
last one put out, the longer shared prefix wins without a look at the bytes, and
only bytes beyond equal prefixes are compared. The merge yields the common
prefix of neighbours, hence which suffixes share how much.

Which suffixes. Sending every suffix would multiply the text by ``length``. Of
each string of ``length`` bytes the leftmost 16 bytes with the least hash are its
anchor; equal strings have their anchor at the same place. Strings starting at
neighbouring bytes share an anchor, so one *entry* stands for some 100 of them:
the suffix at a pivot beside the anchor, with the bytes on its left. For a
string that starts ``d`` bytes before the pivot, equal strings are entries that
agree on ``length - d`` bytes of the suffix and on ``d`` bytes on the left. Both are
read off common prefixes of sorted neighbours (the left sides sorted backwards).

Stages: (1) groups send the hash of each entry's core, the bytes all its strings
share (208 of 400); (2) buckets count cores: an entry whose core is unique
holds no repeated string, as long prefixes that are unique need no sorting; (3)
entries with a repeated core are sorted, front-coded and sent; (4) buckets merge
the runs and answer the repeated starts; (5) groups remove what they cover.

Skew. A group sends equal entries once (and knows itself that they repeat), so a
passage in the same surroundings costs a group one entry. A core with more than
``HOT`` entries, a passage in thousands of different surroundings, would fill one
bucket; its strings are dealt one by one instead, each by its own 64-bit hash, and
are repeated if two groups, or one group twice, hold that hash. This is the exact
way for the rest and takes no bytes to one place. Rows are dealt to groups by id,
text and the partition they lie in, so equal rows or null ids are spread too.
Groups and buckets follow the input size.

Equal entries are told by 128-bit digests, hot strings by 64-bit ones (N of them
are confused N^2 / 2^65 times); all other strings by their bytes.

Defined results: null and empty texts have no bytes; a text shorter than
``length`` is kept; every occurrence of a repeated string goes, also the first;
rows with one id, or a null id, are documents each; matches don't cross documents;
strings are judged on the input; other columns are ignored; an empty table gives
no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartscope.llm.common import (_BYTE, CHUNK_BYTES, _hash_spans, groups_for, id_and_text, mix,
                                  read_documents, ship_package, text_bytes, text_chunks)

LENGTH = 400
GRAM = 16
GROUP_BYTES = 8 << 20
#: Text bytes whose entries share a bucket.
BUCKET_BYTES = 16 << 20
#: Entries of one core that are merged in one bucket.
HOT = 4096

RESULT = "doc_id long, kept binary, n_bytes long, removed array<struct<start:int,stop:int>>"
_ASK = "bucket long, gid long, keys binary, counts binary"
_SEND = "bucket long, gid long, run binary, strings binary"
#: ``kind`` 0: which cores repeat (``first``) and which are hot (``second``); 1: repeated
#: starts of a run's entries (``first``) and repeated hot strings (``second``)
_ANSWER = "gid long, bucket long, kind int, first binary, second binary"


# ------------------------------------------------------------------- entries

@dataclass
class Entries:
    """Entry ``k`` has its pivot at byte ``pivot[k]`` of ``data`` and stands for
    the strings that start ``low[k]`` to ``high[k]`` bytes before it."""
    data: np.ndarray
    off: np.ndarray
    pivot: np.ndarray
    low: np.ndarray
    high: np.ndarray
    key: np.ndarray

    def suffix(self, k: int, length: int) -> bytes:
        return self.data[self.pivot[k]:self.pivot[k] + length - self.low[k]].tobytes()

    def left(self, k: int) -> bytes:
        """Bytes before the pivot, backwards."""
        return self.data[self.pivot[k] - self.high[k]:self.pivot[k]][::-1].tobytes()


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` neighbours."""
    n = len(x)
    rows = -(-n // width)
    grid = np.full(rows * width, np.iinfo(x.dtype).max, dtype=x.dtype)
    grid[:n] = x
    grid = grid.reshape(rows, width)
    ahead = np.minimum.accumulate(grid, axis=1).reshape(-1)
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(back[:n - width + 1], ahead[width - 1:n])


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    h = _BYTE[data]
    width, factor = 1, 0x9E3779B97F4A7C15
    while width < GRAM:
        h = h[:-width] * np.uint64(factor) + h[width:]
        width, factor = width * 2, factor * factor % (1 << 64)
    return mix(h)


def _strings(data: np.ndarray, off: np.ndarray, length: int):
    """Runs of neighbouring starts with one anchor: first start, last start, anchor."""
    if len(data) < length:
        return (np.zeros(0, np.int64),) * 3
    place = np.arange(len(data) - GRAM + 1, dtype=np.uint64)
    ranked = (_gram_hashes(data) & np.uint64(0xFFFFFFFF00000000)) | place
    anchor = (_sliding_min(ranked, length - GRAM + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    inside = np.zeros(len(anchor), dtype=bool)
    for s, e in zip(off[:-1].tolist(), off[1:].tolist()):
        if e - s >= length:
            inside[s:e - length + 1] = True
    start = np.flatnonzero(inside)
    if not len(start):
        return (np.zeros(0, np.int64),) * 3
    anchor = anchor[start]
    new = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (np.diff(start) != 1)]))
    return start[new], start[np.append(new[1:], len(start)) - 1], anchor[new]


def entries(column: pa.Array, length: int) -> Entries:
    """All entries of a group's texts. Anchors far from the pivot make two
    classes, so that the strings of an entry share a long core."""
    reach = (length - GRAM) // 2
    core = length - reach
    blobs, offs, parts, base = [], [np.zeros(1, np.int64)], [], 0
    for _, _, data, off in text_chunks(column, CHUNK_BYTES):
        first, last, anchor = _strings(data, off, length)
        for side, (pivot, lo, hi) in enumerate((
                (anchor, np.maximum(first, anchor - reach), last),
                (anchor - reach - 1, first, np.minimum(last, anchor - reach - 1)))):
            at = np.flatnonzero(lo <= hi)
            p = pivot[at]
            key = mix(_hash_spans(data, p, p + core, _BYTE, False) + np.uint64(side))
            parts.append((p + base, p - hi[at], p - lo[at], key))
        blobs.append(data)
        offs.append(off[1:] + base)
        base += len(data)
    empty = np.zeros(0, np.int64)
    pivot, low, high, key = ((np.concatenate(x) for x in zip(*parts)) if parts
                             else (empty, empty, empty, empty.astype(np.uint64)))
    data = np.concatenate(blobs) if blobs else np.zeros(0, np.uint8)
    return Entries(data, np.concatenate(offs), pivot, low, high, key)


def _distinct(e: Entries, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct entries of a group: one place of each, the number of each
    entry's equal, and how often each distinct one is there."""
    blob = e.data.tobytes()
    digest = xxhash.xxh3_128_digest
    starts, ends = (e.pivot - e.high).tolist(), (e.pivot - e.low + length).tolist()
    raw = b"".join([digest(blob[s:t]) for s, t in zip(starts, ends)])
    names = np.frombuffer(raw, dtype="<u8").reshape(-1, 2).copy()
    # the pivot's place in the bytes, and the class by the core, belong to the name
    names[:, 0] ^= mix(e.key ^ e.high.astype(np.uint64))
    order = np.lexsort((names[:, 1], names[:, 0]))
    names = names[order]
    new = np.ones(len(names), dtype=bool)
    new[1:] = (names[1:] != names[:-1]).any(axis=1)
    number = np.empty(len(names), np.int64)
    number[order] = np.cumsum(new) - 1
    return order[new], number, np.bincount(number, minlength=int(new.sum()))


def _bucket(keys: np.ndarray, buckets: int) -> np.ndarray:
    return (((mix(keys) >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)


def _cuts(sorted_values: np.ndarray):
    """``(value, first, end)`` of each run of equal values."""
    values, first = np.unique(sorted_values, return_index=True)
    return zip(values.tolist(), first.tolist(), [*first[1:].tolist(), len(sorted_values)])


def _raw(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values.astype("<u8")).tobytes()


def _values(raw: bytes | None) -> np.ndarray:
    return np.frombuffer(raw or b"", dtype="<u8")


def _among(values: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Which values are in the sorted ``wanted``."""
    if not len(wanted):
        return np.zeros(len(values), dtype=bool)
    at = np.searchsorted(wanted, values)
    at[at == len(wanted)] = 0
    return wanted[at] == values


# ----------------------------------------------- stages 1 and 2: repeated cores

def _asker(length: int, buckets: int):
    def ask(table: pa.Table) -> pa.Table:
        e = entries(table.column("text"), length)
        one, _, _ = _distinct(e, length)
        keys, counts = np.unique(e.key[one], return_counts=True)
        where = _bucket(keys, buckets)
        order = np.argsort(where, kind="stable")
        keys, counts = keys[order], counts[order]
        gid = table.column("gid")[0].as_py()
        rows = [(b, gid, _raw(keys[s:t]), counts[s:t].astype("<u4").tobytes()) for b, s, t in _cuts(where[order])]
        return _table(rows, ("bucket", pa.int64()), ("gid", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary()))
    return ask


def _table(rows: list[tuple], *fields) -> pa.Table:
    columns = zip(*rows) if rows else [[] for _ in fields]
    return pa.Table.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, fields)],
                                schema=pa.schema(list(fields)))


_ANSWER_FIELDS = (("gid", pa.int64()), ("bucket", pa.int64()), ("kind", pa.int32()),
                  ("first", pa.binary()), ("second", pa.binary()))


def _count_cores(hot: int):
    def count(table: pa.Table) -> pa.Table:
        gids = table.column("gid").to_pylist()
        keys = [_values(x) for x in table.column("keys").to_pylist()]
        counts = [np.frombuffer(x, "<u4") for x in table.column("counts").to_pylist()]
        distinct, where = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.zeros(len(distinct), np.int64)
        np.add.at(total, where, np.concatenate(counts))
        many = np.split(total[where], np.cumsum([len(k) for k in keys])[:-1])
        bucket = table.column("bucket")[0].as_py()
        rows = [(gid, bucket, 0, _raw(k[(n > 1) & (n <= hot)]), _raw(k[n > hot]))
                for gid, k, n in zip(gids, keys, many) if (n > 1).any()]
        return _table(rows, *_ANSWER_FIELDS)
    return count


# ------------------------------------------------- stage 3: front-coded runs

def _common(rows: np.ndarray, limit: np.ndarray) -> np.ndarray:
    """Bytes each row of a matrix shares with the row before, at most the
    shorter's ``limit``."""
    out = np.zeros(len(rows), np.int64)
    for s in range(1, len(rows), 1 << 14):
        t = min(s + (1 << 14), len(rows))
        differs = rows[s:t] != rows[s - 1:t - 1]
        first = differs.argmax(axis=1)
        first[~differs.any(axis=1)] = rows.shape[1]
        out[s:t] = np.minimum(first, np.minimum(limit[s:t], limit[s - 1:t - 1]))
    return out


def _matrix(strings: list[bytes], width: int) -> np.ndarray:
    return np.frombuffer(b"".join([s.ljust(width, b"\0") for s in strings]),
                         dtype=np.uint8).reshape(len(strings), width)


def front_code(strings: list[bytes], width: int) -> bytes:
    """Sorted strings as shared prefix lengths, lengths and the remaining bytes."""
    size = np.array([len(s) for s in strings], np.int64)
    shared = _common(_matrix(strings, max(width, 1)), size) if strings else size
    rest = b"".join([s[h:] for s, h in zip(strings, shared.tolist())])
    return (np.array([len(strings)], "<u4").tobytes() + shared.astype("<u2").tobytes()
            + size.astype("<u2").tobytes() + rest)


def front_decode(raw: bytes) -> tuple[list[bytes], list[int], int]:
    """Strings, shared prefix lengths, and where the coded run ends in ``raw``."""
    n = int(np.frombuffer(raw, "<u4", 1)[0])
    shared = np.frombuffer(raw, "<u2", n, 4).tolist()
    size = np.frombuffer(raw, "<u2", n, 4 + 2 * n).tolist()
    at, last, out = 4 + 4 * n, b"", []
    for h, m in zip(shared, size):
        last = last[:h] + raw[at:at + m - h]
        at += m - h
        out.append(last)
    return out, shared, at


def _run(e: Entries, chosen: np.ndarray, buckets: int, length: int):
    """Chosen distinct entries by bucket, sorted by their bytes: ``(bucket, entries)``.
    The order depends on the bytes alone, so a second pass finds the same."""
    where = _bucket(e.key[chosen], buckets)
    for b, s, t in _cuts(np.sort(where)):
        mine = chosen[where == b].tolist() if t - s < len(chosen) else chosen.tolist()
        yield b, sorted(mine, key=lambda k: (e.suffix(k, length), e.left(k)))


def _hot_strings(e: Entries, hot: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and hashes of the strings of the marked entries."""
    at = np.flatnonzero(hot)
    size = (e.high - e.low + 1)[at]
    starts = (np.repeat(e.pivot[at] - e.high[at], size) + np.arange(size.sum())
              - np.repeat(np.cumsum(size) - size, size))
    digest = xxhash.xxh3_64_intdigest
    blob = e.data.tobytes() if len(at) else b""
    return starts, np.array([digest(blob[s:s + length]) for s in starts.tolist()], dtype=np.uint64)


def _marks(e: Entries, right: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Entries whose core repeats, and those whose core is hot."""
    rows = [r for r in right.to_pylist() if r["kind"] == 0]
    nothing = np.zeros(0, np.uint64)
    settle, hot = (np.sort(np.concatenate([nothing, *(_values(r[c]) for r in rows)])) for c in ("first", "second"))
    return _among(e.key, settle), _among(e.key, hot)


def _sender(length: int, buckets: int):
    def send(left: pa.Table, right: pa.Table) -> pa.Table:
        fields = (("bucket", pa.int64()), ("gid", pa.int64()), ("run", pa.binary()), ("strings", pa.binary()))
        if not left.num_rows or not right.num_rows:
            return _table([], *fields)
        e = entries(left.column("text"), length)
        settle, hot = _marks(e, right)
        one, _, _ = _distinct(e, length)
        gid = left.column("gid")[0].as_py()
        rows = []
        for b, run in _run(e, one[settle[one]], buckets, length):
            lefts = [e.left(k) for k in run]
            # a left side is coded against the one before it: copies share it
            rows.append((b, gid, front_code([e.suffix(k, length) for k in run], length)
                         + front_code(lefts, length), None))
        hashes = np.unique(_hot_strings(e, hot, length)[1])
        where = _bucket(hashes, buckets)
        order = np.argsort(where, kind="stable")
        rows += [(b, gid, None, _raw(hashes[order[s:t]])) for b, s, t in _cuts(where[order])]
        return _table(rows, *fields)
    return send


# ------------------------------------------------------- stage 4: the merge

def _extend(a: bytes, b: bytes, known: int) -> int:
    """Length of the common prefix, of which ``known`` bytes are not looked at."""
    n = min(len(a), len(b))
    x, y = a[known:n], b[known:n]
    if x == y:
        return n
    return n - ((int.from_bytes(x, "big") ^ int.from_bytes(y, "big")).bit_length() + 7) // 8


def merge_runs(runs: list[tuple[list[bytes], list[int]]]) -> tuple[list[tuple[int, int]], list[int]]:
    """Loser tree over sorted runs given with their shared prefix lengths.

    Returns the merged order as ``(run, place)`` and the prefix each entry shares
    with the one before.
    """
    size = 1
    while size < len(runs):
        size *= 2
    place = [0] * size
    head: list[bytes | None] = [r[0][0] if r[0] else None for r in runs] + [None] * (size - len(runs))
    known = [0] * size  # prefix shared with the last entry put out

    def play(x: int, y: int) -> tuple[int, int]:
        """Winner and loser; the loser's known prefix is then that with the winner."""
        a, b = head[x], head[y]
        if b is None:
            return x, y
        if a is None:
            return y, x
        if known[x] != known[y]:
            return (x, y) if known[x] > known[y] else (y, x)
        h = _extend(a, b, known[x])
        if a[h:h + 1] <= b[h:h + 1]:
            known[y] = h
            return x, y
        known[x] = h
        return y, x

    losers = [0] * size
    winners = list(range(size))
    node = size // 2
    while len(winners) > 1:  # the first round, level by level
        level = [play(winners[k], winners[k + 1]) for k in range(0, len(winners), 2)]
        losers[node:node + len(level)] = [y for _, y in level]
        winners = [x for x, _ in level]
        node //= 2
    top = winners[0]
    order, shared = [], []
    while head[top] is not None:
        order.append((top, place[top]))
        shared.append(known[top])
        strings, prefixes = runs[top]
        place[top] += 1
        if place[top] < len(strings):
            head[top], known[top] = strings[place[top]], prefixes[place[top]]
        else:
            head[top] = None
        k = (top + size) // 2
        while k:
            top, losers[k] = play(top, losers[k])
            k //= 2
    return order, shared


def repeated_starts(right: np.ndarray, left: np.ndarray, by_left: np.ndarray, low: np.ndarray,
                    high: np.ndarray, length: int) -> np.ndarray:
    """For entries in the order of their suffixes: which starts (columns, bytes
    before the pivot) another entry repeats. ``right``: prefix shared with the
    suffix before; ``by_left``: entries sorted by left side, ``left``: what each
    shares with the one before in that order."""
    n = len(right)
    out = np.zeros((n, int(high.max()) + 1 if n else 0), dtype=bool)
    for d in range(out.shape[1]):
        at = np.flatnonzero((low <= d) & (d <= high))
        if len(at) < 2:
            continue
        block = np.cumsum(right < length - d)
        side = np.empty(n, np.int64)
        side[by_left] = np.cumsum(left < d)
        key = block[at] * (n + 1) + side[at]
        order = np.argsort(key, kind="stable")
        same = key[order][1:] == key[order][:-1]
        again = np.zeros(len(at), dtype=bool)
        again[1:] |= same
        again[:-1] |= same
        out[at[order[again]], d] = True
    return out


def _settler(length: int):
    def settle(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        gids, runs, lefts = [], [], []
        strings: list[tuple[int, np.ndarray]] = []
        for row in table.to_pylist():
            if row["strings"] is not None:
                strings.append((row["gid"], _values(row["strings"])))
                continue
            suffixes, shared, at = front_decode(row["run"])
            gids.append(row["gid"])
            runs.append((suffixes, shared))
            lefts.append(front_decode(row["run"][at:])[0])
        answers = []
        if runs:
            order, shared = merge_runs(runs)
            side = [lefts[r][k] for r, k in order]
            size = np.array([len(runs[r][0][k]) for r, k in order], np.int64)
            high = np.array([len(x) for x in side], np.int64)
            by_left = np.array(sorted(range(len(side)), key=side.__getitem__), np.int64)
            common = _common(_matrix([side[k] for k in by_left.tolist()], max(1, int(high.max()))), high[by_left])
            again = repeated_starts(np.array(shared, np.int64), common, by_left, length - size, high, length)
            edge = np.diff(np.pad(again, ((0, 0), (1, 1))).astype(np.int8), axis=1)
            entry, first = np.nonzero(edge == 1)
            last = np.nonzero(edge == -1)[1] - 1
            run = np.array([r for r, _ in order], np.int64)
            place = np.array([k for _, k in order], np.int64)
            for r, gid in enumerate(gids):
                mine = run[entry] == r
                if mine.any():
                    found = np.stack([place[entry[mine]], first[mine], last[mine]]).astype("<u4")
                    answers.append((gid, bucket, 1, found.tobytes(), None))
        if strings:
            values, owners = np.unique(np.concatenate([x for _, x in strings]), return_counts=True)
            often = values[owners > 1]
            answers += [(gid, bucket, 1, None, _raw(x[_among(x, often)])) for gid, x in strings
                        if _among(x, often).any()]
        return _table(answers, *_ANSWER_FIELDS)
    return settle


# ------------------------------------------------------- stage 5: the removal

def _remover(length: int, buckets: int):
    def remove(left: pa.Table, right: pa.Table) -> pa.Table:
        fields = (("doc_id", pa.int64()), ("kept", pa.binary()), ("n_bytes", pa.int64()),
                  ("removed", pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))))
        if not left.num_rows:
            return _table([], *fields)
        e = entries(left.column("text"), length)
        one, number, times = _distinct(e, length)
        settle, hot = _marks(e, right)
        change = np.zeros(len(e.data) + 1, np.int64)

        def cover(first: np.ndarray, last: np.ndarray) -> None:
            np.add.at(change, first, 1)
            np.add.at(change, last + length, -1)
        again = times[number] > 1
        cover((e.pivot - e.high)[again], (e.pivot - e.low)[again])
        rows = [r for r in right.to_pylist() if r["kind"] == 1]
        found = {r["bucket"]: np.frombuffer(r["first"], "<u4").reshape(3, -1).astype(np.int64)
                 for r in rows if r["first"] is not None}
        chosen = one[settle[one]]
        by_number = np.argsort(number, kind="stable")
        edges = np.concatenate([[0], np.cumsum(times)])
        for b, run in _run(e, chosen, buckets, length) if found else ():
            if b not in found:
                continue
            place, first, last = found[b]
            which = number[np.array(run, np.int64)[place]]
            copies = times[which]
            at = by_number[np.repeat(edges[which], copies) + np.arange(copies.sum())
                           - np.repeat(np.cumsum(copies) - copies, copies)]
            cover(e.pivot[at] - np.repeat(last, copies), e.pivot[at] - np.repeat(first, copies))
        starts, hashes = _hot_strings(e, hot, length)
        if len(starts):
            values, where, n = np.unique(hashes, return_inverse=True, return_counts=True)
            far = np.sort(np.concatenate([_values(r["second"]) for r in rows] or [values[:0]]))
            gone = (n[where] > 1) | _among(hashes, far)
            cover(starts[gone], starts[gone])
        covered = np.cumsum(change[:-1]) > 0
        out = []
        for doc_id, s, t in zip(left.column("doc_id").to_pylist(), e.off.tolist(), e.off[1:].tolist()):
            gone = covered[s:t]
            edge = np.flatnonzero(np.diff(np.pad(gone.astype(np.int8), 1)))
            out.append((doc_id, e.data[s:t][~gone].tobytes(), t - s,
                        [{"start": a, "stop": b} for a, b in zip(edge[::2].tolist(), edge[1::2].tolist())]))
        return _table(out, *fields)
    return remove


def remove_repeats(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text",
                   group_bytes: int = GROUP_BYTES, bucket_bytes: int = BUCKET_BYTES, hot: int = HOT) -> DataFrame:
    """One row per document: ``doc_id``, ``kept`` (the remaining bytes), ``n_bytes``,
    ``removed`` (maximal byte intervals, end exclusive). ``length`` is 32 or more."""
    if length < 2 * GRAM:
        raise ValueError(f"length must be {2 * GRAM} or more")
    ship_package(docs.sparkSession)
    base = id_and_text(docs, id_col, text_col)
    total = text_bytes(base)
    groups, buckets = groups_for(total, group_bytes), groups_for(total, bucket_bytes)
    dealt = base.withColumn("gid", F.pmod(F.xxhash64("doc_id", "text", F.spark_partition_id()), F.lit(groups)))
    cores = (dealt.groupBy("gid").applyInArrow(_asker(length, buckets), _ASK)
             .groupBy("bucket").applyInArrow(_count_cores(hot), _ANSWER))
    sent = dealt.groupBy("gid").cogroup(cores.groupBy("gid")).applyInArrow(_sender(length, buckets), _SEND)
    found = sent.groupBy("bucket").applyInArrow(_settler(length), _ANSWER)
    return (dealt.groupBy("gid").cogroup(cores.unionByName(found).groupBy("gid"))
            .applyInArrow(_remover(length, buckets), RESULT))


def op12_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    out = remove_repeats(read_documents(spark, sf_dir))
    removed = F.aggregate("removed", F.lit(0).cast("long"),
                          lambda a, s: a + (s["stop"] - s["start"]).cast("long"))
    return out.select("doc_id", "n_bytes", removed.alias("n_removed"),
                      F.size("removed").cast("long").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256"))
