"""Substring dedup by suffix sorting: bytes of a long string that also starts earlier go.

1. Every window of `length` bytes is represented by its smallest 32-byte hash. Windows whose smallest hash
   occurs once in the corpus cannot repeat; the rest are candidates (`exchange`, one packed shuffle).
2. Candidate windows go, as segments of text, to the shard that their smallest hash names: equal windows
   meet in one shard. Equal segments are folded into their first occurrence before and after the shuffle.
3. Each shard sorts its suffixes by external induced sorting (`induced`); neighbours with a common prefix of
   `length` bytes or more are equal windows, of which all but the first are marked. The sort takes some 75 bytes of
   memory a byte, so a shard is read as a stream and sorted in leaves of LEAF bytes: what is more goes to files by the
   bytes that all windows with the smallest hash in the first (or second) half of its possible places share, and each
   file is a shard of its own. Equal windows have it at the same place, so they meet in one leaf.
4. The marks go back to their texts.
"""

import hashlib
import os
import tempfile
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from readsift.llm import exchange, induced
from readsift.llm.vectors import cover, flat, read_spans, releasing, rolling, slices, slide_min, spans_by_text

LENGTH = 100
GRAM = 32  # bytes; a power of two keeps the rolling hash cheap
TILE = 1 << 19  # bytes whose hashes are held at once
PLACE = np.uint64(22)  # lower bits of a hash that give way to its place, so that a minimum tells both
LEAF = 4 << 20  # bytes of segments that one sort takes
SHARE = 3 << 19  # bytes of text per shard, whose segments are some 1.2 times as many; a sort has fixed costs that smaller shards pay more often
FILES = 16  # files that each half of a larger shard is dealt to
MARKS = 1 << 20  # marks that are joined to spans at once


def anchored(data: np.ndarray, offsets: np.ndarray, length: int):
    """Runs of windows with one anchor, their leftmost smallest 32-byte hash: (first byte, windows, text, hash).

    The bytes are worked on in tiles, which overlap by a window, so that memory does not grow with a text.
    """
    parts = []
    for low in range(0, max(len(data) - length + 1, 0), TILE):
        tile = data[low : low + TILE + length - 1]
        grams = exchange.mix(rolling(tile, GRAM))
        # upper bits of the hash, then the place: the minimum tells the leftmost place, whatever repeats
        bits = max(PLACE, np.uint64(len(grams).bit_length()))
        least = slide_min(((grams >> bits) << bits) | np.arange(len(grams), dtype=np.uint64), length - GRAM + 1)
        anchor = (least & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int32)
        # windows that lie in one text: those whose first byte is at least a window before the text's end
        inside = np.zeros(len(least) + 1, np.int32)
        first, last = np.searchsorted(offsets, [low, low + len(least)], "right") - 1
        texts = np.arange(max(first, 0), min(last, len(offsets) - 2) + 1)
        begin = np.clip(offsets[texts] - low, 0, len(least))
        end = np.clip(offsets[texts + 1] - length + 1 - low, begin, len(least))
        np.add.at(inside, begin, 1)
        np.add.at(inside, end, -1)
        at = np.flatnonzero(np.cumsum(inside[:-1], dtype=np.int32))
        if not len(at):
            continue
        own, anchor = np.searchsorted(offsets, at + low, "right") - 1, anchor[at]
        cut = np.ones(len(at), bool)
        cut[1:] = (own[1:] != own[:-1]) | (anchor[1:] != anchor[:-1])
        head = np.flatnonzero(cut)
        parts.append((at[head] + low, np.diff(np.append(head, len(at))), own[head], grams[anchor[head]], anchor[head].astype(np.int64) + low))
    if not parts:
        return None
    start, count, own, smallest, place = (np.concatenate(p) for p in zip(*parts, strict=True))
    fresh = np.ones(len(start), bool)
    fresh[1:] = (own[1:] != own[:-1]) | (place[1:] != place[:-1])  # a run goes on in the next tile
    head = np.flatnonzero(fresh)
    return start[head], np.add.reduceat(count, head), own[head], smallest[head]


def candidates(texts: DataFrame, length: int) -> DataFrame:
    """(doc, chk, parts): spans of windows whose smallest hash occurs twice or more."""
    n = exchange.buckets(texts)

    def send(batches):
        for batch in batches:
            for part in slices(batch):
                data, offsets = flat(part["text"])
                if (found := anchored(data, offsets, length)) is None:
                    continue
                start, count, own, smallest = found
                runs = np.zeros(len(start), exchange.RUN)
                runs["doc"] = part["doc"].to_numpy()[own]
                runs["chk"] = part["chk"].to_numpy()[own]
                runs["start"] = start - offsets[own]
                runs["count"] = count
                yield from exchange.sent(runs, exchange.bucket_of(smallest, n), smallest, False, n)

    return exchange.spans_of(texts.mapInArrow(releasing(send), exchange.SCHEMA), False)


def fold(runs: np.ndarray, segment) -> tuple[np.ndarray, np.ndarray]:
    """First occurrence of each distinct segment (segment(i): bytes of run i), and the runs that start after it.

    Texts that share a doc_id may share the first place, too: it is kept once for each of them.
    """
    first, last, kept, later = {}, {}, [], []
    for i in np.lexsort((runs["chk"], runs["start"], runs["doc"])).tolist():
        j = first.setdefault(raw := segment(i), i)
        if j != i and (runs["doc"][i] != runs["doc"][j] or runs["start"][i] != runs["start"][j]):
            later.append(i)
        elif j == i or runs["chk"][i] != runs["chk"][last.get(raw, j)]:
            kept.append(i)
            if j != i:
                last[raw] = i
    return np.array(kept, np.int64), np.array(later, np.int64)


def packed(runs: np.ndarray, segments: list) -> bytes:
    return np.int32(len(runs)).tobytes() + runs.tobytes() + b"".join(segments)


def opened(payload: bytes, length: int) -> tuple[np.ndarray, list]:
    """The runs of a payload and the bytes of each."""
    n = int(np.frombuffer(payload, np.int32, 1)[0])
    runs = np.frombuffer(payload, exchange.RUN, n, 4)
    ends = (4 + n * exchange.RUN.itemsize + np.cumsum(runs["count"].astype(np.int64) + length - 1)).tolist()
    return runs, [payload[a:b] for a, b in zip([4 + n * exchange.RUN.itemsize, *ends[:-1]], ends, strict=True)]


def send_segments(length: int, n: int):
    def send(batches):
        for batch in batches:
            for part in slices(batch):
                data, offsets = flat(part["text"])
                if (found := anchored(data, offsets, length)) is None:
                    continue
                start, count, own, smallest = found
                spans = [read_spans(parts) + [[offsets[text], 0]] for text, parts in enumerate(part["parts"].to_pylist())]
                spans = np.concatenate(spans)
                begun = np.searchsorted(np.sort(spans[:, 0]), start, "right")
                pick = np.flatnonzero(begun > np.searchsorted(np.sort(spans.sum(axis=1)), start, "right"))
                start, count, own, shard = start[pick], count[pick], own[pick], exchange.bucket_of(smallest[pick], n)
                if not len(start):
                    continue
                runs = np.zeros(len(start), exchange.RUN)
                runs["doc"] = part["doc"].to_numpy()[own]
                runs["chk"] = part["chk"].to_numpy()[own]
                runs["start"] = start - offsets[own]
                runs["count"] = count
                raw = data.tobytes()
                stop = start + count + length - 1
                segment = lambda i, raw=raw, a=start.tolist(), b=stop.tolist(): raw[a[i] : b[i]]
                kept, later = fold(runs, segment)
                if len(later):
                    yield exchange.settled(runs[later], n)
                kept = kept[np.argsort(shard[kept], kind="stable")]
                places, at = np.unique(shard[kept], return_index=True)
                ends = np.append(at[1:], len(kept))
                payloads = [packed(runs[kept[a:b]], [segment(i) for i in kept[a:b].tolist()]) for a, b in zip(at, ends, strict=True)]
                yield exchange.rows(bucket=places.astype(np.int32), payload=pa.array(payloads, pa.binary()))

    return send


def joined_spans(marks: list) -> pa.RecordBatch:
    doc, chk, spans = spans_by_text(*(np.concatenate([m[c] for m in marks]) for c in ("doc", "chk", "start", "count")))
    return pa.RecordBatch.from_arrays([pa.array(doc, pa.int64()), pa.array(chk.astype(np.int64)), spans], names=["doc", "chk", "spans"])


def shard_marks(length: int, leaf: int):
    """One shard, as a stream: spans of the windows that also start earlier, and spans that were settled before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, marks, n = [], [], 0

        def payloads():
            for batch in batches:
                settled = batch.filter(pa.compute.is_valid(batch["spans"])).select(["doc", "chk", "spans"])
                if settled.num_rows:
                    before.append(settled)
                yield from batch["payload"].drop_null().to_pylist()

        for part in settle(payloads(), length, leaf, 0, length - GRAM):
            yield from before
            before.clear()
            if len(part):
                marks.append(part)
                n += len(part)
            if n > MARKS:
                yield joined_spans(marks)
                marks, n = [], 0
        yield from before
        if marks:
            yield joined_spans(marks)

    return run


def settle(payloads: Iterable[bytes], length: int, leaf: int, low: int, high: int):
    """Runs of windows that start earlier elsewhere in the payloads; the smallest hash is at low to high in each window."""
    payloads, held, size = iter(payloads), [], 0
    for payload in payloads:
        held.append(payload)
        size += len(payload)
        if size > leaf and low < high:
            break
    else:  # a leaf; windows of one place have been dealt by all their bytes
        parts = [opened(p, length) for p in held]
        if not parts:
            return
        runs, segments = np.concatenate([p[0] for p in parts]), list(chain.from_iterable(p[1] for p in parts))
        parts, held = None, None
        kept, later = fold(runs, segments.__getitem__)
        yield runs[later]
        runs = runs[kept]
        sizes = runs["count"].astype(np.int64) + length - 1
        data = np.frombuffer(b"".join([segments[i] for i in kept.tolist()]), np.uint8)
        segments = None
        yield from repeats(data, np.cumsum(sizes) - sizes, sizes, runs, length)
        return
    with tempfile.TemporaryDirectory() as folder:
        middle = (low + high) // 2
        halves = [(low, middle), (middle + 1, high)]
        for runs, segments in pieces(chain(held, payloads), length):
            held = None
            kept, later = fold(runs, segments.__getitem__)
            yield runs[later]
            deal(runs[kept], [segments[i] for i in kept.tolist()], length, halves, folder)
        for half in halves:
            for paths in leaves([path for k in range(FILES) if os.path.exists(path := os.path.join(folder, f"{half[0]}-{k}"))], leaf):
                yield from settle(chain.from_iterable(map(from_file, paths)), length, leaf, *half)
                for path in paths:
                    os.unlink(path)


def leaves(paths: list, leaf: int):
    """The files in groups of at most `leaf` bytes; a larger file is a group of its own."""
    group, size = [], 0
    for path in paths:
        own = os.path.getsize(path)
        if group and size + own > leaf:
            yield group
            group, size = [], 0
        group.append(path)
        size += own
    if group:
        yield group


def pieces(payloads: Iterable[bytes], length: int):
    """(runs, segments) of the payloads in pieces of about TILE bytes."""
    runs, segments, size = [], [], 0
    for payload in payloads:
        own, texts = opened(payload, length)
        ends = np.cumsum(own["count"].astype(np.int64) + length - 1)
        cuts = np.unique(np.append(np.searchsorted(ends, np.arange(0, ends[-1] if len(ends) else 0, TILE)), len(own)))
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            runs.append(own[a:b])
            segments += texts[a:b]
            size += int(ends[b - 1] - (ends[a - 1] if a else 0))
            if size >= TILE:
                yield np.concatenate(runs), segments
                runs, segments, size = [], [], 0
    if runs:
        yield np.concatenate(runs), segments


def deal(runs: np.ndarray, segments: list, length: int, halves: list, folder: str) -> None:
    """Add to each half's files the windows whose smallest hash is in that half, by the bytes that all such windows share."""
    raw = b"".join(segments)
    data = np.frombuffer(raw, np.uint8)
    sizes = runs["count"].astype(np.int64) + length - 1
    first = np.cumsum(sizes) - sizes
    grams = exchange.mix(rolling(data, GRAM))
    least = np.append(((grams >> PLACE) << PLACE) | np.arange(len(grams), dtype=np.uint64), np.uint64(0xFFFFFFFFFFFFFFFF))
    # the smallest hash of a segment is that of each of its windows
    least = np.minimum.reduceat(least, np.stack([first, first + sizes - GRAM + 1]).T.reshape(-1))[::2]
    place = (least & ((np.uint64(1) << PLACE) - np.uint64(1))).astype(np.int64) - first
    for low, high in halves:
        begin, end = np.maximum(place - high, 0), np.minimum(place - low, runs["count"].astype(np.int64) - 1)
        own = np.flatnonzero(begin <= end)
        if not len(own):
            continue
        begin, end = begin[own], end[own]
        out = runs[own]
        out["start"] += begin.astype(np.uint32)
        out["count"] = end - begin + 1
        shared = rolling(data, length - high + low)[first[own] + place[own] - low]
        to = exchange.bucket_of(shared + np.uint64(high - low), FILES)
        begin, end = (first[own] + begin).tolist(), (first[own] + end + length).tolist()
        for k in np.unique(to).tolist():
            pick = np.flatnonzero(to == k)
            payload = packed(out[pick], [raw[begin[i] : end[i]] for i in pick.tolist()])
            with open(os.path.join(folder, f"{low}-{k}"), "ab") as file:
                file.write(np.int64(len(payload)).tobytes() + payload)


def from_file(path: str):
    with open(path, "rb") as file:
        while head := file.read(8):
            yield file.read(int(np.frombuffer(head, np.int64)[0]))


def repeats(data: np.ndarray, first: np.ndarray, sizes: np.ndarray, runs: np.ndarray, length: int):
    """Windows of the segments that equal a window which starts earlier, from the sorted suffixes."""
    of = np.repeat(np.arange(len(first), dtype=np.int32), sizes)
    rest_pos, rest_new = np.zeros(0, np.int64), np.zeros(0, bool)
    for pos, common in induced.sorted_suffixes(data, length):
        new = common < length
        # a group may go on in the next block: keep the last one back
        pos, new = np.append(rest_pos, pos), np.append(rest_new, new)
        heads = np.flatnonzero(new)
        cut = int(heads[-1]) if len(heads) else 0
        rest_pos, rest_new = pos[cut:], new[cut:]
        yield _later(pos[:cut], new[:cut], of, first, sizes, runs, length)
    yield _later(rest_pos, rest_new, of, first, sizes, runs, length)


def _later(pos, new, of, first, sizes, runs, length):
    group = np.cumsum(new)
    whole = pos + length <= first[of[pos]] + sizes[of[pos]]  # the window ends inside its segment
    pos, group = pos[whole], group[whole]
    times = np.bincount(group) if len(group) else np.zeros(1, np.int64)
    many = times[group] > 1
    pos, group = pos[many], group[many]
    hit = runs[of[pos]]
    hit["start"] += (pos - first[of[pos]]).astype(np.uint32)
    hit["count"] = 1
    order = np.lexsort((hit["start"], hit["doc"], group))
    hit, group = hit[order], group[order]
    head = np.ones(len(hit), bool)
    head[1:] = group[1:] != group[:-1]
    lead = hit[np.maximum.accumulate(np.where(head, np.arange(len(hit)), 0))] if len(hit) else hit
    return hit[(hit["doc"] != lead["doc"]) | (hit["start"] != lead["start"])]


def shards(docs: DataFrame) -> int:
    """As many shards as the bytes of all texts ask for, so that a shard does not grow with the input."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(exchange.buckets(docs), -(-size // SHARE))


def whole_characters(text: np.ndarray, gone: np.ndarray) -> np.ndarray:
    """The bytes that go, with the rest of each UTF-8 character that loses some."""
    of = np.cumsum((text & 0xC0) != 0x80)
    return np.bincount(of, gone)[of] > 0


def dedup_substrings(docs: DataFrame, length: int = LENGTH, carry: tuple = (), characters: bool = False, leaf: int = LEAF) -> DataFrame:
    """Bytes kept by each text: (doc_id, n_bytes, n_removed, n_spans, kept binary, carried struct of the columns `carry`).

    A byte goes if a string of `length` bytes over it also starts earlier in the input: in a text with a
    smaller doc_id, or earlier in the same text. Null text is empty; a null doc_id is smaller than any other and
    stays null. Rows that repeat a doc_id are the same place in that order: at equal starts neither is earlier.
    With `characters`, `kept` has no character in part: what a cut leaves of one goes too, uncounted.
    Other columns are ignored. `leaf`: bytes of segments that are sorted at once; results do not depend on it.
    """
    if length < GRAM:
        raise ValueError(f"length must be at least {GRAM}")
    texts = exchange.keyed(docs)
    n = shards(docs)
    with_spans = exchange.texts_with(texts, candidates(texts, length), "inner").select("doc", "chk", "text", "parts")
    marks = (
        with_spans.mapInArrow(releasing(send_segments(length, n)), exchange.SCHEMA)
        .groupBy("bucket").applyInArrow(shard_marks(length, leaf), exchange.SPANS)
        .groupBy("doc", "chk").agg(F.collect_list("spans").alias("parts"))
    )
    whole = exchange.keyed(docs, carry)
    joined = exchange.texts_with(whole, marks, "left").select("doc", "text", "parts", "carried")

    def cut(batches):
        for batch in batches:
            out = []
            for text, parts in zip(batch["text"].cast(pa.binary()).to_pylist(), batch["parts"].to_pylist(), strict=True):
                n_bytes, removed, spans = len(text), 0, 0
                if parts:
                    gone = cover(read_spans(parts), n_bytes, length - 1)
                    removed = int(gone.sum())
                    spans = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                    text = np.frombuffer(text, np.uint8)
                    text = text[~(whole_characters(text, gone) if characters else gone)].tobytes()
                out.append((n_bytes, removed, spans, text))
            yield pa.RecordBatch.from_arrays(
                [batch["doc"], *(pa.array([x[i] for x in out], pa.int64()) for i in range(3)), pa.array([x[3] for x in out], pa.binary()), batch["carried"]],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "carried"],
            )

    carried = joined.schema["carried"].dataType.simpleString()
    kept = joined.mapInArrow(releasing(cut), f"doc_id long, n_bytes long, n_removed long, n_spans long, kept binary, carried {carried}")
    return kept.withColumn("doc_id", F.nullif("doc_id", F.lit(exchange.NO_ID)))


def digest(kept: DataFrame) -> DataFrame:
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def brute_force(docs: list, length: int = LENGTH) -> list:
    """(n_bytes, n_removed, n_spans, kept_sha256) per (doc_id, text), straight from the definition; for tests."""
    low = exchange.NO_ID
    first = {}
    raw = [(low if i is None else i, (t or "").encode()) for i, t in docs]
    for i, t in raw:
        for p in range(len(t) - length + 1):
            k = t[p : p + length]
            first[k] = min(first.get(k, (i, p)), (i, p))
    out = []
    for i, t in raw:
        gone = bytearray(len(t))
        for p in range(len(t) - length + 1):
            if first[t[p : p + length]] < (i, p):
                gone[p : p + length] = b"\x01" * length
        kept = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        spans = sum(1 for x in range(len(t)) if gone[x] and (x == 0 or not gone[x - 1]))
        out.append((len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out
