"""SentencePiece encoding and decoding with the N best segmentations.

The lattice of a text: every vocabulary piece that matches somewhere is an edge with the piece's score. The
forward Viterbi pass gives each place the best score from the start to it; the backward A* search then extends
partial segmentations from the end, with those scores as exact heuristics, so that segmentations come out in
descending order of score. Word beginnings cut the lattice: no piece crosses into the mark of a next word, so a
text's N best segmentations are combined from those of its words, and each distinct word is searched once.

Characters outside the vocabulary fall back to their bytes (`<0x..>` pieces), as in the model.
"""

import heapq
import re
from collections import Counter
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
import sentencepiece
from pyspark.sql import DataFrame, functions as F

from readsift.llm.vectors import flat, release, slices

MODEL = "piece_bpe_32k.model"
MARK = "▁"
NBEST = 4
KNOWN = 80_000  # words remembered, in two generations
BYTE_SCORE = -40_000.0  # below every piece of the vocabulary, so that bytes are a last resort
TOGETHER = 3 << 18  # bytes of text whose distinct words are looked up at once
LETTERS = 320  # that the prefix table has columns for
TOP = 0x250  # letters below are in the prefix table even where no piece has them
LONG = 40  # letters of words that are searched together
ROWS = 1 << 15  # words that are searched at once
FEW = 64  # fewer words than these go one by one: arrays have a price of their own
NONE = float("-inf")
CUT = re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")
_made = {}


class Words(dict):
    """Best segmentation of each word, found when first asked for: (score, ids as bytes, score lost by the second best)."""

    def __init__(self, find):
        self.find = find

    def __missing__(self, word: str) -> tuple:
        got = self.find(word)
        if len(self) < KNOWN:  # those learned for this slice are still to be asked for
            self[word] = got
        return got


class Model:
    """Pieces with scores, and the N best segmentations of marked words."""

    def __init__(self, name: str = MODEL, n: int = NBEST):
        self.library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(name))
        self.n = n
        ids, self.byte = {}, {}
        self.raw = []
        for i in range(self.library.get_piece_size()):
            piece = self.library.id_to_piece(i)
            self.raw.append(piece.encode())
            if self.library.is_byte(i):
                self.byte[int(piece[3:5], 16)] = i
                self.raw[i] = bytes([int(piece[3:5], 16)])
            elif not (self.library.is_control(i) or self.library.is_unknown(i) or self.library.is_unused(i)):
                ids[piece] = (max(self.library.get_score(i), BYTE_SCORE), np.array([i], "<u4").tobytes())
        # beginnings of pieces -> (score, id as bytes, if it is a piece; whether a longer piece begins so)
        longer = {p[:k] for p in ids for k in range(1, len(p))}
        self.raws = pa.array(self.raw, pa.large_binary())
        self.trie = {p: (*ids.get(p, (0.0, None)), p in longer) for p in longer | set(ids)}
        for c in {p for p in longer if len(p) == 1 and p not in ids}:
            self.trie[c] = (*self.unknown(c)[:2], True)
        for c in map(chr, range(128)):
            self.trie.setdefault(c, self.unknown(c))
        self.forget()
        self.tables()

    def unknown(self, c: str) -> tuple:
        """A character that is no piece goes as its bytes."""
        raw = c.encode()
        return BYTE_SCORE * len(raw), np.array([self.byte[b] for b in raw], "<u4").tobytes(), False

    def edges(self, word: str, start: int):
        """(end, score, ids as bytes) of the pieces that begin at a place."""
        for end in range(start + 1, len(word) + 1):
            found = self.trie.get(word[start:end])
            if found is None:
                if end > start + 1:
                    return
                found = self.unknown(word[start])
            if found[1] is not None:
                yield end, found[0], found[1]
            if not found[2]:
                return

    def viterbi(self, word: str) -> tuple:
        """Best score, its ids as little-endian 32-bit bytes, and how much the second best segmentation loses."""
        n = len(word)
        best, second, back = [NONE] * (n + 1), [NONE] * (n + 1), [None] * (n + 1)
        best[0] = 0.0
        look = self.trie.get
        for start in range(n):
            here, after = best[start], second[start]
            end = start
            while end < n:
                end += 1
                found = look(word[start:end])
                if found is None:
                    if end > start + 1:
                        break
                    found = self.unknown(word[start])
                score, ids, longer = found
                if ids is not None:
                    got = here + score
                    if got > best[end]:
                        second[end] = max(best[end], after + score)
                        best[end] = got
                        back[end] = (start, ids)
                    else:
                        second[end] = max(second[end], got, after + score)
                if not longer:
                    break
        out, at = [], n
        while at:
            at, ids = back[at]
            out.append(ids)
        return best[n], b"".join(reversed(out)), best[n] - second[n]

    def forget(self) -> None:
        """Words met so far, which would stay with an idle worker."""
        self.known, self.before, self.searched = Words(self.viterbi), {}, {}
        release()

    def tables(self) -> None:
        """The prefix table for whole arrays of words: states by letter, for the LETTERS letters that longer pieces use most.

        Letters that no longer piece has lead nowhere, and nothing leads to them.
        """
        use = Counter(c for p in self.trie if len(p) > 1 for c in p)
        letters = [c for c, _ in sorted(use.items(), key=lambda x: (-x[1], x[0]))[:LETTERS]]
        self.letter = {c: i for i, c in enumerate(letters)}
        lone = [c for c in map(chr, range(TOP)) if c not in use] + [p for p in self.trie if len(p) == 1 and p not in use and ord(p) >= TOP]
        states = [p for p in self.trie if len(p) > 1 and all(c in self.letter for c in p)] + letters + lone
        # states that lead on come first and have a row each; a last row is for all others
        states.sort(key=lambda p: (not self.trie.get(p, (0, 0, False))[2], p))
        number = {p: i + 1 for i, p in enumerate(states)}  # 0: no piece begins so
        self.ahead = 1 + sum(self.trie.get(p, (0, 0, False))[2] for p in states)
        self.next = np.zeros((self.ahead + 1, len(letters) + 1), np.min_scalar_type(len(number)))
        self.score, self.size = np.full(len(number) + 1, NONE), np.zeros(len(number) + 1, np.int64)
        pieces = [b""] * (len(number) + 1)
        for p, i in number.items():
            if len(p) > 1:
                self.next[number[p[:-1]], self.letter[p[-1]]] = i
            score, ids, _ = self.trie.get(p) or self.unknown(p)
            self.size[i] = len(p)
            if ids is not None:
                self.score[i], pieces[i] = score, ids
        self.pieces = pa.array(pieces, pa.large_binary())
        codes = {ord(c): i for c, i in self.letter.items()} | {ord(c): len(letters) + i for i, c in enumerate(lone)}
        self.first = np.array([number[chr(c)] for c in codes], np.int64)
        self.code_of = np.full(max(codes) + 2, -1, np.int64)  # the last one is for all letters beyond
        self.code_of[list(codes)] = list(codes.values())

    def coded(self, words: list) -> np.ndarray:
        """The letters of words, one word after the other; -1 for those beyond the prefix table."""
        letters = np.frombuffer("".join(words).encode("utf-32-le"), "<u4")
        return self.code_of[np.minimum(letters, len(self.code_of) - 1)]

    def learn(self, words: set) -> None:
        """Find the best segmentations of words that are new, many at once.

        Words asked for again outlive the generation they were found in; the others are forgotten with it.
        """
        missing = words - self.known.keys()
        if self.known and len(self.known) + len(missing) > KNOWN // 2:
            self.before, self.known, missing = self.known, Words(self.viterbi), words
        again = missing & self.before.keys()
        self.known.update((w, self.before[w]) for w in again)
        new = sorted(missing - again, key=len, reverse=True)
        if len(self.known) + len(self.before) + len(new) > KNOWN:
            self.before = {}
        if len(new) < FEW:
            return
        sizes = np.fromiter(map(len, new), np.int64, len(new))
        simple = (np.minimum.reduceat(self.coded(new), np.cumsum(sizes) - sizes) >= 0) & (sizes <= LONG)
        new = [new[i] for i in np.flatnonzero(simple).tolist()]
        for at in range(0, len(new), ROWS):
            group = new[at : at + ROWS]
            if len(group) >= FEW:
                self.known.update(zip(group, self.viterbi_all(group, len(group[0])), strict=True))

    def viterbi_all(self, words: list, n: int) -> list:
        """`viterbi` of many words of at most n letters: the same steps on arrays, one per place."""
        sizes, rows = np.fromiter(map(len, words), np.int64, len(words)), len(words)
        order = np.argsort(-sizes, kind="stable")  # longest first: those that reach a place are the first so many
        letters, begin, sizes = self.coded(words), (np.cumsum(sizes) - sizes)[order], sizes[order]
        reach = np.searchsorted(-sizes, -np.arange(n + 1), "right").tolist()
        chars = [letters[begin[:k] + place] for place, k in enumerate(reach[1:])]
        columns = [np.minimum(c, len(self.letter)) for c in chars]
        best, second, via = ([np.full(k, x, t) for k in reach] for x, t in ((NONE, float), (NONE, float), (0, self.next.dtype)))
        best[0][:] = 0.0
        step, width = self.next.ravel(), len(self.letter) + 1
        for start in range(n):
            here, after = best[start], second[start]
            live, state = slice(reach[start + 1]), self.first[chars[start]]
            for end in range(start + 1, n + 1):
                if end > start + 1:
                    k = np.searchsorted(live, reach[end]) if end > start + 2 else reach[end]
                    live = live[:k] if end > start + 2 else np.arange(k)
                    state = step[np.minimum(state[:k], self.ahead) * width + columns[end - 1][live]]
                    on = np.flatnonzero(state)
                    if not len(on):
                        break
                    live, state = live[on], state[on].astype(np.int64)
                at, own, score = live, state, self.score[state]
                if end > start + 1:
                    on = np.flatnonzero(score > NONE)
                    at, own, score = at[on], own[on], score[on]
                got, was = here[at] + score, best[end][at]
                second[end][at] = np.maximum(np.maximum(second[end][at], after[at] + score), np.minimum(got, was))
                better = got > was
                best[end][at] = np.maximum(got, was)
                via[end][at] = np.where(better, own, via[end][at])
        base = np.cumsum([0, *reach[:-1]])
        via, last = np.concatenate(via), base[sizes] + np.arange(rows)
        out = np.zeros((rows, n), via.dtype)
        used = np.zeros(rows, np.int64)
        live, place = np.arange(rows), sizes
        while len(live):
            used[live] += 1
            own = via[base[place] + live]
            out[live, n - used[live]] = own
            place = place - self.size[own]
            live, place = live[place > 0], place[place > 0]
        raw, ends = flat(self.pieces.take(pa.array(out[out > 0])))
        raw, ends = raw.tobytes(), ends[np.cumsum(np.append(0, used))]
        best, second = np.concatenate(best)[last], np.concatenate(second)[last]
        back = np.empty(rows, np.int64)
        back[order] = np.arange(rows)
        return [(b, raw[a:z], g) for b, a, z, g in zip(best[back].tolist(), ends[:-1][back].tolist(), ends[1:][back].tolist(), (best - second)[back].tolist(), strict=True)]

    def search(self, word: str) -> list:
        """The n best segmentations of a word: (score, ids as bytes), best first, by backward A*."""
        into = [[] for _ in range(len(word) + 1)]
        best = [0.0] + [NONE] * len(word)
        for start in range(len(word)):
            for end, score, ids in self.edges(word, start):
                into[end].append((start, score, ids))
                best[end] = max(best[end], best[start] + score)
        found = []
        # (negated best total, ids from here to the end, place, score from here to the end)
        agenda = [(-best[-1], b"", len(word), 0.0)]
        while agenda and len(found) < self.n:
            _, ids, place, behind = heapq.heappop(agenda)
            if place == 0:
                found.append((behind, ids))
                continue
            for start, score, own in into[place]:
                heapq.heappush(agenda, (-(best[start] + score + behind), own + ids, start, score + behind))
        return found

    def words(self, text: str) -> list:
        """The marked text cut before each run of marks; no piece crosses these cuts."""
        return CUT.findall(MARK + text.replace(" ", MARK)) if text else []

    def cut(self, texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
        """`words` of each text: all words, the number of each text's first (one more entry than texts), the marked texts' bytes and their offsets."""
        texts = texts.cast(pa.large_string())
        mark, none = (pa.scalar(x, pa.large_string()) for x in (MARK, ""))
        marked = pc.binary_join_element_wise(mark, pc.replace_substring(texts, " ", MARK), none)
        data, offsets = flat(pc.if_else(pc.equal(pc.binary_length(texts), 0), texts, marked))
        mark = np.zeros(len(data) + 3, bool)
        mark[3:-2] = (data[:-2] == 0xE2) & (data[1:-1] == 0x96) & (data[2:] == 0x81)
        begin = mark[3:] & ~mark[:-3]  # a mark after a mark goes on with its run
        begin[offsets[:-1][offsets[1:] > offsets[:-1]]] = True
        begin = np.flatnonzero(begin)
        words = pa.LargeStringArray.from_buffers(len(begin), pa.py_buffer(np.append(begin, len(data))), pa.py_buffer(data))
        return words, np.searchsorted(begin, offsets), data, offsets

    def encode(self, text: str) -> list:
        """The n best segmentations of a text, best first: (score, {word number: ids as bytes} that differ from the best).

        The first entry is (score, ids of the whole text as bytes).
        """
        words = self.words(text)
        firsts = list(map(self.known.__getitem__, words))
        total = sum([f[0] for f in firsts])
        return [(total, b"".join([f[1] for f in firsts])), *self.after(total, np.array([f[2] for f in firsts]), words.__getitem__)]

    def after(self, total: float, gaps: np.ndarray, word) -> list:
        """The second to the n-th best segmentation: (score, {word number: ids as bytes} that differ from the best, which scores total).

        A segmentation among the n best differs from the best one only in words whose second best loses least (gaps: what each
        word's loses): n such words are enough, and only they are searched. word: the word of a number.
        """
        best = [(total, {})]
        least = np.flatnonzero(gaps <= np.partition(gaps, self.n - 1)[self.n - 1]) if len(gaps) > self.n else np.arange(len(gaps))
        for i in least[np.argsort(gaps[least], kind="stable")][: self.n].tolist():
            if gaps[i] == -NONE:
                break
            own = self.searched.get(word(i))
            if own is None:
                if len(self.searched) >= KNOWN // 5:
                    self.searched.clear()
                own = self.searched[word(i)] = self.search(word(i))
            grown = [(score + s - own[0][0], {**changes, i: ids} if k else changes) for score, changes in best for k, (s, ids) in enumerate(own)]
            best = sorted(grown, key=lambda x: -x[0])[: self.n]
        return best[1:]

    def others(self, best: list, ends: np.ndarray, first, right: bool) -> list:
        """(score, [(first piece, pieces, ids as bytes that stand for them)], decoded) of the segmentations after the best one.

        ends: pieces of the best one before each word; first: its ids in the word of a number, as bytes; right: whether it decodes
        to the text. One whose changed words spell the same bytes decodes to what it does.
        """
        out = []
        for score, changes in best:
            parts = [(int(ends[i]), len(first(i)) // 4, ids) for i, ids in sorted(changes.items())]
            out.append((score, parts, right and all(self.spelled(ids) == self.spelled(first(i)) for i, ids in changes.items())))
        return out

    def segmented(self, texts: pa.Array) -> tuple[pa.Array, list, list, list]:
        """Of texts without nulls: ids of the best segmentation, scores of the n best, whether ids decode to the text, `others`.

        The words of all texts are looked up once each; their ids and the bytes these spell are gathered per text.
        """
        words, begin, data, offsets = self.cut(texts)
        words = words.dictionary_encode()
        index, distinct = words.indices.to_numpy(), words.dictionary.to_numpy(zero_copy_only=False).tolist()
        self.learn(set(distinct))
        found = list(map(self.known.__getitem__, distinct))
        scores, gaps = (np.array([f[k] for f in found], float)[index] for k in (0, 2))
        ids, ends = flat(pa.array([f[1] for f in found], pa.large_binary()).take(words.indices))
        ids, place = ids.view("<u4"), ends // 4
        letters, spelled = flat(self.raws.take(pa.array(ids)))
        letters, spelled, data, offsets = letters.tobytes(), spelled[place[begin]].tolist(), data.tobytes(), offsets.tolist()
        number = begin.tolist()
        totals, right, more = [], [], []
        for k, (a, z) in enumerate(zip(number[:-1], number[1:], strict=True)):
            same = letters[spelled[k] : spelled[k + 1]] == data[offsets[k] : offsets[k + 1]]
            right.append(same or self.decode(ids[place[a] : place[z]].tobytes()) == texts[k].as_py().replace(MARK, " "))
            total = float(scores[a:z].sum())
            best = self.after(total, gaps[a:z], lambda i, a=a: distinct[index[a + i]])
            totals.append([total, *[s for s, _ in best]])
            more.append(self.others(best, place[a:z] - place[a], lambda i, a=a: found[index[a + i]][1], right[-1]))
        sent = pa.Array.from_buffers(pa.large_binary(), len(begin) - 1, [None, pa.py_buffer(ends[begin]), pa.py_buffer(ids)]).cast(pa.binary())
        return sent, totals, right, more

    def spelled(self, ids: bytes) -> bytes:
        """The bytes of pieces, marks included."""
        return b"".join(map(self.raw.__getitem__, np.frombuffer(ids, "<u4").tolist()))

    def decode(self, ids: bytes) -> str:
        """Text of ids: bytes joined, marks as spaces, the first mark dropped."""
        text = self.spelled(ids).decode("utf-8", "replace").replace(MARK, " ")
        return text[1:] if text.startswith(" ") else text


def model(name: str, n: int) -> Model:
    """One per worker process."""
    if (name, n) not in _made:
        _made[name, n] = Model(name, n)
    return _made[name, n]


def segmented(docs: DataFrame, name: str = MODEL, n: int = NBEST) -> DataFrame:
    """(doc_id, n_pieces, ids binary, scores array, decoded boolean, others array of (score, changes, decoded)) per row.

    ids: the best segmentation, little-endian 32-bit; scores: of the n best, descending, as far as there are
    that many; others: the second to the n-th best, in that order, as changes of the
    best one's ids, (at, n, ids) for the n ids from place at on: `segmentations` writes them out; decoded: decoding ids gives the text again (a mark in a text comes back as a space). Null text is empty: no pieces, one score
    of zero. Equal scores come in a fixed order. Repeated rows and null ids are encoded like any other; other columns are ignored.
    """

    def run(batches):
        own = model(name, n)
        for batch in batches:
            for part in slices(batch, size=TOGETHER):
                ids, scores, decoded, more = own.segmented(part["text"])
                rest = [x for xs in more for x in xs]
                changes = [c for x in rest for c in x[1]]
                changes = pa.StructArray.from_arrays([pa.array([c[i] for c in changes], t) for i, t in enumerate((pa.int32(), pa.int32(), pa.binary()))], names=["at", "n", "ids"])
                changes = pa.ListArray.from_arrays(pa.array([0, *accumulate(len(x[1]) for x in rest)], pa.int32()), changes)
                others = pa.StructArray.from_arrays([pa.array([x[0] for x in rest], pa.float64()), changes, pa.array([x[2] for x in rest], pa.bool_())], names=["score", "changes", "decoded"])
                others = pa.ListArray.from_arrays(pa.array([0, *accumulate(map(len, more))], pa.int32()), others)
                n_pieces = pc.divide(pc.binary_length(ids), 4).cast(pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part["doc_id"], n_pieces, ids, pa.array(scores, pa.list_(pa.float64())), pa.array(decoded, pa.bool_()), others],
                    names=["doc_id", "n_pieces", "ids", "scores", "decoded", "others"],
                )
        own.forget()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_pieces long, ids binary, scores array<double>, decoded boolean, others array<struct<score: double, changes: array<struct<at: int, n: int, ids: binary>>, decoded: boolean>>")


def segmentations(rows: DataFrame) -> DataFrame:
    """(doc_id, segmentations array of (score, ids, decoded)): the n best of each row of `segmented`, best first, written out."""

    def whole(changes):
        kept = lambda a, end: F.substring(F.col("ids"), a["place"] * 4 + 1, (end - a["place"]) * 4)
        start = F.struct(F.expr("X''").alias("done"), F.lit(0).alias("place"))
        step = lambda a, c: F.struct(F.concat(a["done"], kept(a, c["at"]), c["ids"]).alias("done"), (c["at"] + c["n"]).alias("place"))
        return F.aggregate(changes, start, step, lambda a: F.concat(a["done"], kept(a, F.col("n_pieces").cast("int"))))

    best = F.struct(F.get("scores", F.lit(0)).alias("score"), F.col("ids").alias("ids"), F.col("decoded").alias("decoded"))
    more = F.transform("others", lambda o: F.struct(o["score"].alias("score"), whole(o["changes"]).alias("ids"), o["decoded"].alias("decoded")))
    return rows.select("doc_id", F.concat(F.array(best), more).alias("segmentations"))
