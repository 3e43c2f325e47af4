"""Removal of repeated passages by suffix arrays, built by linear grouping.

A byte goes where a string of ``LENGTH`` bytes covers it that starts somewhere
else too. Every such window has an anchor, its first gram with the smallest
hash, which depends on the window's bytes alone, so equal windows meet under
one anchor. Neighbouring windows with one anchor form a chunk.

1. Texts are dealt out in blocks; a block sends each different (anchor, chunk
   hash) once, with its count, to the anchor's segment.
2. The segment answers, a byte each, in the block's order: nobody else has the
   anchor; the whole chunk occurs again (all its windows are repeated); or the
   anchor has different chunks, which may share windows.
3. The block marks whole repeats and sends the undecided chunks, with one copy
   of each repeated one under the same anchor.
4. Under an anchor, chunks are cut to what they share with a neighbour on either
   side of it, equal ones become one, and a suffix array over the rest shows
   which windows stand next to an equal one. Anchors with more than
   ``GROUP_CHUNKS`` undecided chunks count hashes of their windows instead, which
   shuffle by window, so no group has to fit a task.

The suffix array is built in two phases without recursive renaming. Phase one
refines groups of suffixes in descending order: the members of a group point to
the nearest suffix before them in a lower group, and what they point to moves up
within its own group, by how often. Phase two goes through the order ascending
and puts the suffixes whose Lyndon prefix ends there at the front of their groups.

Cases: null and empty texts have nothing to remove; texts below ``LENGTH`` bytes
stay whole; repeated rows repeat each other; an empty table gives an empty result.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from strata.llm import common
from strata.session import materialise

LENGTH = 200
GRAM = 32
GROUP_CHUNKS = 5_000  # about 1.5 MB of chunks, 200 MB of a task's memory while they are sorted
ALONE, REPEATED, LENT, OPEN = range(4)


def suffix_array(s: Sequence[int]) -> list[int]:
    """Order of all suffixes of whole numbers; the last one must be smallest and occur once."""
    n = len(s)
    letters = sorted(set(s))
    rank = {letter: i for i, letter in enumerate(letters)}
    group = [rank[letter] for letter in s]
    members: list[list[int]] = [[] for _ in letters]
    for i, g in enumerate(group):
        members[g].append(i)
    below, above = list(range(-1, len(letters) - 1)), [*range(1, len(letters)), -1]
    jump = list(range(n + 1))  # place p at p + 1: itself while its group is open, else somewhere to the left; 0: none
    before = [-1] * n
    done: list[tuple[int, int]] = []
    current = len(letters) - 1
    while current >= 0:
        own = [i for i in members[current] if group[i] == current]
        members[current] = []
        done.append((current, len(own)))
        for i in own:
            jump[i + 1] = i
        votes: dict[int, int] = {}
        for i in own:
            p = i
            while jump[p] != p:
                jump[p] = p = jump[jump[p]]
            before[i] = p - 1
            if p:
                votes[p - 1] = votes.get(p - 1, 0) + 1
        levels: dict[int, dict[int, list[int]]] = {}
        for p, n_votes in votes.items():
            levels.setdefault(n_votes, {}).setdefault(group[p], []).append(p)
        for n_votes in sorted(levels, reverse=True):
            for g, part in levels[n_votes].items():
                new = len(members)  # stands right above what stays of its group
                members.append(part)
                for p in part:
                    group[p] = new
                up = above[g]
                above[g] = new
                below.append(g)
                above.append(up)
                if up >= 0:
                    below[up] = new
        current = below[current]

    front: dict[int, int] = {}
    at = 0
    for g, size in reversed(done):
        front[g] = at
        at += size
    out, placed = [-1] * n, [False] * n
    out[0], placed[n - 1] = n - 1, True
    for i in range(n):
        j = out[i] - 1
        while j >= 0 and not placed[j]:
            g = group[j]
            out[front[g]] = j
            front[g] += 1
            placed[j] = True
            j = before[j]
    return out


def window_chunks(flat: np.ndarray, at: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """Chunks of all texts of a piece: text number, first byte in the piece, windows,
    hash of the anchor gram, hash of the chunk's bytes; and the hashes of all grams."""
    width = length - gram + 1
    m = len(flat) - length + 1
    if m <= 0:
        none = np.empty(0, np.int64)
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64), none.astype(np.uint64)
    sums, (_, down) = common.prefix_hashes(flat), common.powers(len(flat))
    n = len(flat) - gram + 1
    hashes = common.mix64((sums[gram:] - sums[:n]) * down[:n])
    # Sliding minimum over `width` grams from the minima of fixed blocks, read from both sides.
    padded = np.full(-(-n // width) * width, np.uint64(2**64 - 1))
    padded[:n] = hashes
    ahead = np.minimum.accumulate(padded.reshape(-1, width), axis=1).ravel()
    behind = np.minimum.accumulate(padded.reshape(-1, width)[:, ::-1], axis=1)[:, ::-1].ravel()
    low = np.minimum(behind[:m], ahead[width - 1 : width - 1 + m])
    owner = np.repeat(np.arange(len(at) - 1), np.diff(at))[:m]
    inside = at[owner + 1] - np.arange(m) >= length
    # A new chunk where the minimum changes, or where the place of the minimum has just been left.
    turn = np.concatenate([[True], (low[1:] != low[:-1]) | (hashes[: m - 1] == low[:-1]) | (owner[1:] != owner[:-1])])
    first = np.flatnonzero(turn & inside)
    stops = np.append(np.flatnonzero(turn | ~inside), m)
    last = stops[np.searchsorted(stops, first, side="right")]
    content = common.mix64((sums[last + length - 1] - sums[first]) * down[first] + (last - first).astype(np.uint64))
    return owner[first], first, last - first, low[first], content, hashes


def _pairs_of(batches: list[pa.RecordBatch], column: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Different (anchor, chunk hash) of a block, sorted, with counts."""
    anchors, contents = [np.empty(0, np.uint64)], [np.empty(0, np.uint64)]
    for batch in common.pieces(iter(batches), column):
        _, _, _, anchor, content, _ = window_chunks(*common.bytes_of(batch.column(column)))
        anchors.append(anchor)
        contents.append(content)
    anchor, content = np.concatenate(anchors), np.concatenate(contents)
    order = np.lexsort((content, anchor))
    anchor, content = anchor[order], content[order]
    start = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (content[1:] != content[:-1])])) if len(anchor) else np.empty(0, np.int64)
    return anchor[start], content[start], np.diff(np.append(start, len(anchor)))


def _send(key: tuple, table: pa.Table, n_segments: int) -> pa.Table:
    anchor, content, n = _pairs_of(table.to_batches(), 1)
    rows = [(key[0].as_py(), s, anchor[a:b].tobytes() + content[a:b].tobytes(), common.small_counts(n[a:b])) for s, a, b in common.by_segment(anchor, n_segments)]
    kinds = [pa.int32(), pa.int32(), pa.binary(), pa.binary()]
    return pa.table([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names=["block", "segment", "keys", "counts"])


def _answer(key: tuple, table: pa.Table) -> pa.Table:
    blobs = [np.frombuffer(k.as_py(), np.uint64).reshape(2, -1) for k in table["keys"]]
    size = [b.shape[1] for b in blobs]
    anchor, content = np.concatenate([b[0] for b in blobs]), np.concatenate([b[1] for b in blobs])
    n = np.concatenate([common.read_counts(c.as_py(), w) for c, w in zip(table["counts"], size)])
    order = np.lexsort((np.repeat(table["block"].to_numpy(), size), content, anchor))
    a, c = anchor[order], content[order]
    new_anchor = np.concatenate([[True], a[1:] != a[:-1]])
    new_pair = new_anchor | np.concatenate([[True], c[1:] != c[:-1]])
    pair, group = np.cumsum(new_pair) - 1, np.cumsum(new_anchor) - 1
    total = np.bincount(pair, n[order]).astype(np.int64)[pair]  # occurrences of the chunk
    different = np.bincount(group, new_pair)[group] > 1  # chunks of the anchor
    undecided = np.bincount(group, total == 1)[group] > 0
    code = np.where(total > 1, np.where(different & undecided & new_pair, LENT, REPEATED), np.where(different, OPEN, ALONE)).astype(np.uint8)
    out = np.empty(len(code), np.uint8)
    out[order] = code
    cut = np.concatenate([[0], np.cumsum(size)])
    answers = [out[x:y].tobytes() for x, y in zip(cut, cut[1:])]
    return pa.table([table["block"].combine_chunks(), pa.array([key[0].as_py()] * len(answers), pa.int32()), common.binary_array(answers)], names=["block", "segment", "codes"])


# Columns of what a block sends on: texts (kind 0) and chunks (kind 1) in one table.
_PASSED = "kind int, rid long, bytes binary, spans binary, anchor long, chunk binary, place int, start long, windows int"


def _mark(n_segments: int, carried: list[tuple[str, pa.DataType]]):
    """Per block: its texts with the windows of whole repeats marked, and the chunks to compare."""

    def run(key: tuple, docs: pa.Table, answers: pa.Table) -> pa.Table:
        anchor, content, _ = _pairs_of(docs.to_batches(), 1)
        codes = np.zeros(len(anchor), np.uint8)
        known = dict(zip(answers["segment"].to_pylist(), answers["codes"]))
        for s, a, b in common.by_segment(anchor, n_segments):
            codes[a:b] = np.frombuffer(known[s].as_py(), np.uint8)
        lent: set[int] = set()
        texts, chunks, rows = [], [], key[0].as_py() << 33
        for batch in common.pieces(iter(docs.to_batches()), 1):
            flat, at = common.bytes_of(batch.column(1))
            owner, first, windows, own_anchor, own_content, hashes = window_chunks(flat, at)
            # Both keys are unique numbers per pair: find by anchor, then step to the chunk hash.
            place = _find(anchor, content, own_anchor, own_content)
            code = codes[place]
            for i in np.flatnonzero(code >= LENT):
                if code[i] == LENT:
                    if place[i] in lent:
                        continue
                    lent.add(place[i])
                f, w = int(first[i]), int(windows[i])
                gram = f + w - 1 + int(np.argmin(hashes[f + w - 1 : f + LENGTH - GRAM + 1]))
                rid = rows + int(owner[i]) if code[i] == OPEN else None
                chunks.append((rid, int(own_anchor[i].view(np.int64)), flat[f : f + w + LENGTH - 1].tobytes(), gram - f, f - int(at[owner[i]]), w))
            whole = (code == REPEATED) | (code == LENT)
            edge = np.searchsorted(owner[whole], np.arange(batch.num_rows + 1))
            spans = np.stack([first[whole], first[whole] + windows[whole] + LENGTH - 1], axis=1) - at[owner[whole]][:, None]
            texts.append((batch, np.arange(rows, rows + batch.num_rows), [_merge(spans[a:b]).astype("<i8").tobytes() for a, b in zip(edge, edge[1:])]))
            rows += batch.num_rows
        n_texts, n = sum(len(t[1]) for t in texts), sum(len(t[1]) for t in texts) + len(chunks)
        pad = lambda values, kind: pa.concat_arrays([*values, pa.nulls(len(chunks), kind)]) if values or chunks else pa.array([], kind)
        tail = lambda i, kind: pa.concat_arrays([pa.nulls(n_texts, kind), pa.array([c[i] for c in chunks], kind)])
        columns = [
            pa.array([0] * n_texts + [1] * len(chunks), pa.int32()),
            pa.concat_arrays([*[pa.array(t[1], pa.int64()) for t in texts], pa.array([c[0] for c in chunks], pa.int64())]),
            pad([t[0].column(1) for t in texts], pa.binary()), pad([common.binary_array(t[2]) for t in texts], pa.binary()),
            tail(1, pa.int64()), tail(2, pa.binary()), tail(3, pa.int32()), tail(4, pa.int64()), tail(5, pa.int32()),
            *[pad([t[0].column(2 + i) for t in texts], kind) for i, (_, kind) in enumerate(carried)]]
        assert all(len(c) == n for c in columns)
        return pa.table(columns, names=["kind", "rid", "bytes", "spans", "anchor", "chunk", "place", "start", "windows", *[c for c, _ in carried]])

    return run


def _find(anchor: np.ndarray, content: np.ndarray, a: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Place of each (a, c) in the sorted different pairs (anchor, content)."""
    place, top = np.searchsorted(anchor, a), np.searchsorted(anchor, a, side="right")
    while True:  # binary search by chunk hash within the anchor's run
        wide = np.flatnonzero(top - place > 1)
        if not len(wide):
            return place
        middle = (place[wide] + top[wide]) // 2
        up = content[middle] <= c[wide]
        place[wide] = np.where(up, middle, place[wide])
        top[wide] = np.where(up, top[wide], middle)


def _merge(spans: np.ndarray) -> np.ndarray:
    """Sorted spans without overlaps; touching ones become one."""
    if not len(spans):
        return np.empty((0, 2), np.int64)
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    end = np.maximum.accumulate(spans[:, 1])
    first = np.flatnonzero(np.concatenate([[True], spans[1:, 0] > end[:-1]]))
    return np.stack([spans[first, 0], np.append(end[first[1:] - 1], end[-1])], axis=1)


def _shared(sides: list[bytes]) -> list[int]:
    """For each string the longest prefix it has in common with another."""
    order = sorted(range(len(sides)), key=sides.__getitem__)
    out = [0] * len(sides)
    for x, y in zip(order, order[1:]):
        p, q = sides[x], sides[y]
        n = min(len(p), len(q))
        if p[:n] != q[:n]:
            n = int((np.frombuffer(p, np.uint8, n) != np.frombuffer(q, np.uint8, n)).argmax())
        out[x], out[y] = max(out[x], n), max(out[y], n)
    return out


def repeated_windows(texts: list[bytes], weights: list[int], length: int = LENGTH) -> list[np.ndarray]:
    """Per text the starts of windows that occur again, in it or another; a text of weight 2 stands for two."""
    if len(texts) == 1:
        n = max(0, len(texts[0]) - length + 1)
        if weights[0] > 1:
            return [np.arange(n)]
    letters: list[int] = []
    for i, text in enumerate(texts):
        letters += [b + len(texts) + 1 for b in text]
        letters.append(len(texts) - i)  # a border of its own, the last one 1
    letters.append(0)
    edges = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
    order = np.array(suffix_array(letters))
    flat = np.concatenate([np.frombuffer(t + b"\0", np.uint8) for t in texts])
    owner = np.searchsorted(edges, order, side="right") - 1
    room = np.append(edges[1:] - 1, 0)[np.minimum(owner, len(texts))] - order
    whole = (owner < len(texts)) & (room >= length)
    found = np.zeros(len(letters), bool)
    for i in np.flatnonzero(whole & (np.array([*weights, 0])[np.minimum(owner, len(texts))] > 1)):
        found[order[i]] = True
    near = np.flatnonzero(whole[1:] & whole[:-1])
    for at in range(0, len(near), 4096):
        x, y = order[near[at : at + 4096]], order[near[at : at + 4096] + 1]
        span = np.arange(length)
        same = (flat[x[:, None] + span] == flat[y[:, None] + span]).all(axis=1)
        found[x[same]] = found[y[same]] = True
    return [np.flatnonzero(found[edges[i] : edges[i + 1]]) for i in range(len(texts))]


def _runs(starts: np.ndarray) -> list[tuple[int, int]]:
    """First and last of each run of whole numbers."""
    cut = np.flatnonzero(np.diff(starts) > 1)
    return list(zip(starts[np.concatenate([[0], cut + 1])].tolist(), starts[np.append(cut, len(starts) - 1)].tolist())) if len(starts) else []


def _compare(table: pa.Table) -> pa.Table:
    """Repeated windows of the undecided chunks of some anchors, by suffix array."""
    groups: dict[int, list[int]] = defaultdict(list)
    for i, a in enumerate(table["anchor"].to_pylist()):
        groups[a].append(i)
    rids, starts, places = table["rid"].to_pylist(), table["start"].to_pylist(), table["place"].to_pylist()
    chunk = table["chunk"].to_pylist()
    out: list[tuple[int, int, int]] = []
    for own in groups.values():
        left = _shared([chunk[i][: places[i]][::-1] for i in own])
        right = _shared([chunk[i][places[i] :] for i in own])
        cut: dict[bytes, list[tuple[int, int]]] = defaultdict(list)
        for i, x, y in zip(own, left, right):
            if x + y >= LENGTH:
                cut[chunk[i][places[i] - x : places[i] + y]].append((i, places[i] - x))
        if not cut:
            continue
        weights = [sum(1 if rids[i] is not None else 2 for i, _ in held) for held in cut.values()]
        for held, windows in zip(cut.values(), repeated_windows(list(cut), weights)):
            for a, b in _runs(windows):
                out += [(rids[i], starts[i] + off + a, starts[i] + off + b + LENGTH) for i, off in held if rids[i] is not None]
    return pa.table([pa.array([r[i] for r in out], pa.int64()) for i in range(3)], names=["rid", "a", "b"])


def _window_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per window of a chunk: anchor, hash of the window and of its place by the anchor, weight, owner, start."""
    for batch in batches:
        for row in batch.to_pylist():
            flat = np.frombuffer(row["chunk"], np.uint8)
            n = row["windows"]
            sums, (_, down) = common.prefix_hashes(flat), common.powers(len(flat))
            hashes = common.mix64((sums[LENGTH : LENGTH + n] - sums[:n]) * down[:n])
            yield pa.RecordBatch.from_arrays(
                [pa.array([row["anchor"]] * n, pa.int64()), pa.array(hashes.view(np.int64)), pa.array([1 if row["rid"] is not None else 2] * n, pa.int64()),
                 pa.array([row["rid"]] * n, pa.int64()), pa.array(row["start"] + np.arange(n), pa.int64())], names=["anchor", "window", "weight", "rid", "a"])


def repeated_spans(df: DataFrame, text: str = "text", carry: Sequence[str] = ()) -> tuple[DataFrame, list[str]]:
    """Every text as (bytes, spans of whole repeats as packed pairs of 64-bit
    numbers, carried columns, array of further repeated spans), and the names of the carried columns."""
    spark = df.sparkSession
    common.small_batches(spark)
    _, n_bytes = common.input_bytes(df, text)
    n_segments = common.count_blocks(n_bytes)
    named = [f"c{i}" for i in range(len(carry))]
    source = df.select(common.text_bytes(text).alias("bytes"), *[F.col(c).alias(n) for c, n in zip(carry, named)])
    dealt = source.withColumn("block", F.pmod(F.xxhash64("bytes", *named), F.lit(n_segments)).cast("int"))
    kinds = [(n, to_arrow_type(df.schema[c].dataType)) for c, n in zip(carry, named)]

    def send(key: tuple, table: pa.Table) -> pa.Table:
        return _send(key, table, n_segments)

    answers = materialise(dealt.select("block", "bytes").groupBy("block").applyInArrow(common.tidy_group(send), "block int, segment int, keys binary, counts binary")
                          .groupBy("segment").applyInArrow(common.tidy_group(_answer), "block int, segment int, codes binary"), "chunk-codes")
    schema = _PASSED + "".join(f", {n} {df.schema[c].dataType.simpleString()}" for c, n in zip(carry, named))
    passed = materialise(dealt.select("block", "bytes", *named).groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(common.tidy_group(_mark(n_segments, kinds)), schema), "marked-texts")

    chunks = passed.where("kind = 1").select("rid", "anchor", "chunk", "place", "start", "windows")
    sizes = materialise(chunks.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("chunk")).alias("size")), "anchor-sizes")
    total = sizes.where(F.col("n") <= GROUP_CHUNKS).agg(F.sum("size")).first()[0] or 0
    n_bins = max(1, -(-int(total) // (1 << 20)))
    busy = sizes.where(F.col("n") > GROUP_CHUNKS).select("anchor")
    few = chunks.join(busy, "anchor", "left_anti").withColumn("bin", F.pmod(F.xxhash64("anchor"), F.lit(n_bins)))
    found = few.groupBy("bin").applyInArrow(common.tidy_group(_compare), "rid long, a long, b long")
    windows = chunks.join(busy, "anchor").select("rid", "anchor", "chunk", "start", "windows").mapInArrow(common.tidy(_window_hashes), "anchor long, window long, weight long, rid long, a long")
    again = windows.groupBy("anchor", "window").agg(F.sum("weight").alias("n")).where("n > 1").select("anchor", "window")
    counted = windows.where("rid IS NOT NULL").join(again, ["anchor", "window"]).select("rid", "a", (F.col("a") + LENGTH).alias("b"))
    marks = found.unionByName(counted).groupBy("rid").agg(F.collect_list(F.struct("a", "b")).alias("marks"))

    texts = passed.where("kind = 0").select("rid", "bytes", "spans", *named)
    open_ids = materialise(marks, "chunk-marks")
    joined = texts.join(open_ids, "rid", "left").drop("rid")

    return joined, named


def keep_rest(text: bytes, spans: np.ndarray, whole_characters: bool = False) -> tuple[bytes, np.ndarray]:
    """The bytes outside the spans, and the spans. ``whole_characters`` narrows
    spans so that no character is cut, for texts that go on as strings."""
    if whole_characters and len(spans):
        lead = np.append((np.frombuffer(text, np.uint8) & 0xC0) != 0x80, True)
        starts = np.flatnonzero(lead)
        spans = np.stack([starts[np.searchsorted(starts, spans[:, 0])], starts[np.searchsorted(starts, spans[:, 1], side="right") - 1]], axis=1)
        spans = spans[spans[:, 1] > spans[:, 0]]
    edges = [0, *spans.ravel().tolist(), len(text)]
    return b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2])), spans


def remove_repeats(df: DataFrame, text: str = "text", carry: Sequence[str] = ("doc_id",), whole_characters: bool = False) -> DataFrame:
    """Carried columns with ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept`` (the bytes that stay)."""

    joined, named = repeated_spans(df, text, carry)
    made = [common.own_name(df.select(*carry), n) for n in ("n_bytes", "n_removed", "n_spans", "kept")]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, n = [], []
            for text_, spans, more in zip(batch.column(0), batch.column(1), batch.column(batch.num_columns - 1)):
                spans, whole = np.frombuffer(spans.as_py(), "<i8").reshape(-1, 2), text_.as_py()
                if more.is_valid:
                    spans = _merge(np.concatenate([spans, np.stack([f.to_numpy() for f in more.values.flatten()], axis=1)]))
                rest, own = keep_rest(whole, spans, whole_characters)
                kept.append(rest)
                n.append((len(whole), len(whole) - len(rest), len(own)))
            yield pa.RecordBatch.from_arrays([*batch.columns[2:-1], *[pa.array([x[i] for x in n], pa.int64()) for i in range(3)], common.binary_array(kept)], names=[*carry, *made])

    columns = ", ".join([f"`{c}` {df.schema[c].dataType.simpleString()}" for c in carry] + [f"`{n}` long" for n in made[:3]] + [f"`{made[3]}` binary"])
    return joined.select("bytes", "spans", *named, "marks").mapInArrow(common.tidy(cut), columns)


def op2_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
