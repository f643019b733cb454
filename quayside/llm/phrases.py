"""Collocations: phrases of two to four words whose words belong together, counted in tries of word ids.

Texts are lower-cased (A-Z), cut at `[.,;:!?` and line ends into pieces, and pieces at blanks and tabs into words. Counting
follows the HAT-trie: within a task words get ids, and every position of a piece adds its longest phrase of up to four
words to a trie of its language. Hash containers, each shared by the phrases of `SHARED` first words, count them; a
container that grows beyond `BURST` bursts into a node with a container a word, and so on by the next words. Shorter
phrases need no entry of their own: their counts are the sums over their subtrees.

When a task's tries hold `HELD` entries, its largest subtrees leave it whole, as one run sorted by phrase, until half is
left; the runs are written to the shared folder. They are dealt out by ranges of phrases, so that a prefix however
frequent is split where it has many continuations, and each range is merged in order: equal phrases add up, and with them
all their prefixes, in memory for one batch. A prefix that reaches across ranges sums up once more in a small aggregation.

A candidate's cuts, the counts of its parts, and the longer candidates that hold it come by joins of the frequent phrases
with themselves, on (language, phrase). Scores are exact: products are decimals.

Defined cases: a null text is empty; a null language is `und`, and joins rows that say so; control characters and bytes
beyond ASCII are part of words; equal rows count as often as they occur; texts of any length are read in chunks; an empty
table gives an empty result; other columns of the input do not matter.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import broadcast_if_small, written
from .text import flat

WORDS, LEAST, TOP = 4, 30, 2000
#: A longer candidate with so many hundredths of the count covers a shorter one.
COVERS = 80
#: Entries of a container before it bursts, entries and words a task holds, and rows of a run that leave at once.
BURST, HELD, VOCABULARY, LEAVING = 1 << 16, 1_000_000, 1 << 18, 1 << 16
#: Bytes of text cut into words at a time (far fewer than ids have room for), and words put into a trie at a time.
CHUNK, BLOCK = 1 << 19, 1 << 20
#: Bits of a word id, and first words that share a container: four ids less what the container says fit 63 bits.
_BITS, SHARED = 19, 64
_MASK = (1 << _BITS) - 1
_TOP = _BITS * (WORDS - 1)
_ENDS = [bytes((c,)) for c in b" \t\n\x0b\x0c\r.,;:!?"]
_CUT = bytes.maketrans(b".,;:!?\x0b\x0c\r\t", b"\n\n\n\n\n\n\n\n\n ")
_ESCAPE = 0x7F
_LOW = bytes((*range(33), _ESCAPE))
#: A run's key is language, tab, phrase; no language or word holds a byte up to the blank (see `escaped`).
RUNS = "key string, n long"


def escaped(word: bytes) -> bytes:
    """The word without bytes up to the blank, so that keys sort as their words do."""
    if word.translate(None, _LOW) == word:
        return word
    return b"".join(bytes((_ESCAPE, c + 64)) if c <= 32 else bytes((_ESCAPE, _ESCAPE)) if c == _ESCAPE else bytes((c,)) for c in word)


def unescaped(phrase: bytes) -> bytes:
    if _ESCAPE not in phrase:
        return phrase
    out, it = bytearray(), iter(phrase)
    for c in it:
        if c == _ESCAPE:
            c = next(it)
            c = c if c == _ESCAPE else c - 64
        out.append(c)
    return bytes(out)


class _Ids(dict):
    """Ids of words, given out from 1 on; 0 is the cut between pieces, -1 the nothing between two blanks."""

    def __init__(self) -> None:
        super().__init__({b"\n": 0, b"": -1})

    def __missing__(self, word: bytes) -> int:
        self[word] = at = len(self) - 1
        return at


class Node:
    """Containers of counts by the id of a word, or by SHARED of them at the root; keys are the bits below."""

    def __init__(self, bits: int) -> None:
        self.bits = bits
        self.children: dict[int, Counter | Node] = {}
        self.sizes: dict[int, int] = {}

    def add(self, ids: np.ndarray, keys: np.ndarray, counts: np.ndarray | None = None) -> int:
        """Add keys to the children of these ids, which are in order; gives the number of new entries."""
        cuts = np.flatnonzero(np.diff(ids, prepend=-1))
        new = 0
        for child_id, low, high in zip(ids[cuts].tolist(), cuts.tolist(), [*cuts[1:].tolist(), len(ids)]):
            given, times = keys[low:high], None if counts is None else counts[low:high]
            child = self.children.get(child_id)
            if isinstance(child, Node):
                more = child.split(given, times)
            else:
                if child is None:
                    child = self.children[child_id] = Counter()
                before = len(child)
                child.update(given.tolist() if times is None else dict(zip(given.tolist(), times.tolist())))
                more = len(child) - before
                if len(child) > BURST and self.bits > _BITS:
                    node = self.children[child_id] = Node(_TOP if self.bits > _TOP else self.bits - _BITS)
                    node.split(*_arrays(child))
            self.sizes[child_id] = self.sizes.get(child_id, 0) + more
            new += more
        return new

    def split(self, keys: np.ndarray, counts: np.ndarray | None) -> int:
        """Add keys by their next word."""
        order = np.argsort(keys, kind="stable")
        keys = keys[order]
        return self.add(keys >> self.bits, keys & ((1 << self.bits) - 1), None if counts is None else counts[order])

    def leave(self, entries: int) -> list[int]:
        """The largest subtrees that together hold so many entries."""
        out, total = [], 0
        for child_id in sorted(self.sizes, key=self.sizes.__getitem__, reverse=True):
            if total >= entries:
                break
            out.append(child_id)
            total += self.sizes[child_id]
        return out

    def entries(self, child_id: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Keys and counts of one subtree."""
        child = self.children[child_id]
        if not isinstance(child, Node):
            yield _arrays(child)
            return
        for below in child.children:
            for keys, counts in child.entries(below):
                yield keys | (below << child.bits), counts


def _arrays(container: Counter) -> tuple[np.ndarray, np.ndarray]:
    n = len(container)
    return np.fromiter(container.keys(), np.int64, n), np.fromiter(container.values(), np.int64, n)


def longest_phrases(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Container and key of the longest phrase at each word of a run of ids; ids 0 end a piece."""
    padded = np.concatenate([ids, np.zeros(WORDS - 1, np.int64)])
    n = len(ids)
    word = padded[:n]
    packed, open_ = word % SHARED, word > 0
    for j in range(1, WORDS):
        at = padded[j : n + j]
        open_ = open_ & (at > 0)
        packed = packed << _BITS | np.where(open_, at, 0)
    return (word // SHARED)[word > 0], packed[word > 0]


class Counting:
    """The tries of a task, by language, and what leaves them."""

    def __init__(self) -> None:
        self._start()

    def _start(self) -> None:
        self.ids, self.tries, self.held = _Ids(), {}, 0

    def add(self, lang: str, texts: Iterable[memoryview]) -> Iterator[pa.RecordBatch]:
        """Count texts of one language; yields the runs that leave meanwhile."""
        ids: list[np.ndarray] = []
        size = 0
        for text in texts:
            for chunk in _chunks(text):
                words = chunk.lower().translate(_CUT).replace(b"\n", b" \n ").split(b" ")
                found = np.fromiter(map(self.ids.__getitem__, words), np.int64, len(words))
                found = found[found >= 0]
                ids.append(found)
                size += len(found)
                if size >= BLOCK or len(self.ids) > VOCABULARY:
                    # the last words open phrases that go on: they come again with the next block
                    run = np.concatenate(ids)
                    yield from self._count(lang, run[: len(run) - WORDS + 1], run[len(run) - WORDS + 1 :])
                    ids = [self._known(run[len(run) - WORDS + 1 :])]
                    size = len(ids[0])
            ids.append(np.zeros(1, np.int64))
            size += 1
        if ids:
            yield from self._count(lang, np.concatenate(ids), np.zeros(0, np.int64))

    def _known(self, tail: np.ndarray) -> np.ndarray:
        """Ids of the words that are carried on, which may have been given anew."""
        return tail if self._tail is None else np.array([self.ids[w] for w in self._tail], np.int64)

    def _count(self, lang: str, run: np.ndarray, tail: np.ndarray) -> Iterator[pa.RecordBatch]:
        n = len(run)
        words, packed = longest_phrases(np.concatenate([run, tail]))
        # positions of the tail are counted with the block that follows
        here = int((run > 0).sum())
        words, packed = words[:here], packed[:here]
        order = np.argsort(words, kind="stable")
        trie = self.tries.setdefault(lang, Node(_BITS * WORDS))
        self.held += trie.add(words[order], packed[order])
        self._tail = None
        if len(self.ids) > VOCABULARY:
            names = list(self.ids)
            self._tail = [b"\n" if i == 0 else names[i + 1] for i in tail.tolist()]
            yield from self.finish()
        elif self.held > HELD:
            yield from self._spill(HELD // 2)

    def _spill(self, entries: int) -> Iterator[pa.RecordBatch]:
        words = _Words(self.ids)
        for lang in sorted(self.tries, key=lambda name: -sum(self.tries[name].sizes.values())):
            if entries <= 0:
                break
            trie = self.tries[lang]
            leaving = trie.leave(entries)
            yield from words.run(lang, trie, leaving)
            gone = sum(trie.sizes.pop(i) for i in leaving)
            entries -= gone
            self.held -= gone

    def finish(self) -> Iterator[pa.RecordBatch]:
        """Everything that is left, as sorted runs."""
        words = _Words(self.ids)
        for lang, trie in self.tries.items():
            yield from words.run(lang, trie, list(trie.children))
        self._start()


class _Words:
    """Words by id, and their ranks in byte order."""

    def __init__(self, ids: _Ids) -> None:
        names = list(ids)[2:]
        whole = b"".join(names)
        if len(whole.translate(None, _LOW)) < len(whole):
            names = list(map(escaped, names))
        # id 0 stands for a word that is not there
        self.names = pa.array([None, *names], pa.binary())
        self.rank = np.zeros(len(names) + 1, np.int64)
        if names:
            self.rank[1:] = pc.rank(self.names[1:], tiebreaker="first").to_numpy()

    def run(self, lang: str, trie: Node, leaving: list[int]) -> Iterator[pa.RecordBatch]:
        """The rows of these subtrees, sorted; the subtrees leave the trie before that."""
        found = []
        for i in leaving:
            found += [(np.full(len(keys), i, np.int64), keys, counts) for keys, counts in trie.entries(i)]
            del trie.children[i]
        if not found:
            return
        group, keys, counts = map(np.concatenate, zip(*found))
        ids = [group * SHARED + (keys >> _TOP)] + [keys >> (_BITS * (WORDS - 1 - j)) & _MASK for j in range(1, WORDS)]
        first, second, third, fourth = (self.rank[i] for i in ids)
        order = np.lexsort([third << _BITS | fourth, first << _BITS | second])
        name = pa.scalar(escaped(lang.encode()), pa.binary())
        for low in range(0, len(order), LEAVING):
            at = order[low : low + LEAVING]
            words = [self.names.take(pa.array(i[at])) for i in ids]
            words[0] = pc.binary_join_element_wise(name, words[0], pa.scalar(b"\t", pa.binary()))
            # a word that is not there is a null, which joining skips
            joined = pc.binary_join_element_wise(*words, pa.scalar(b" ", pa.binary()), null_handling="skip")
            yield pa.RecordBatch.from_arrays([joined.cast(pa.string()), pa.array(counts[at])], names=["key", "n"])


def _chunks(text: memoryview) -> Iterator[bytes]:
    """The text in parts of about CHUNK bytes, each ending behind a word or at the text's end."""
    at, n = 0, len(text)
    while n - at > CHUNK:
        to, step = -1, CHUNK
        while to < 0 and at + step < n:
            part = bytes(text[at : at + step])
            to = max(map(part.rfind, _ENDS))
            step *= 2
        if to < 0:
            break
        yield part[: to + 1]
        at += to + 1
    yield bytes(text[at:])


def count_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Task: rows (lang, text) to sorted runs of phrases."""
    counting = Counting()
    for batch in batches:
        langs = batch.column("lang").dictionary_encode()
        data, offsets = flat(batch.column("text"))
        view, which = memoryview(data), langs.indices.to_numpy(zero_copy_only=False)
        for i, lang in enumerate(langs.dictionary.to_pylist()):
            own = np.flatnonzero(which == i).tolist()
            yield from counting.add(lang, (view[offsets[k] : offsets[k + 1]] for k in own))
    yield from counting.finish()


def _ends(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For each key the lengths of its prefixes: the language, then 1 to WORDS words; -1 where it has fewer."""
    n = len(offsets) - 1
    cuts = np.flatnonzero(data <= 0x20)
    row = np.searchsorted(offsets, cuts, "right") - 1
    nth = np.arange(len(cuts)) - np.searchsorted(row, row)
    ends = np.full((WORDS + 1, n), -1, np.int64)
    ends[nth, row] = cuts - offsets[row]
    ends[np.bincount(row, minlength=n), np.arange(n)] = offsets[1:] - offsets[:-1]
    return ends


def _same_as_before(data: np.ndarray, offsets: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Which rows have the prefix of this length in common with the row before, itself of the same length."""
    same = np.zeros(len(length), bool)
    at = np.flatnonzero((length[1:] == length[:-1]) & (length[1:] > 0)) + 1
    if len(at):
        size = length[at]
        first = np.cumsum(size) - size
        within = np.arange(int(size.sum())) - np.repeat(first, size)
        differ = data[within + np.repeat(offsets[at], size)] != data[within + np.repeat(offsets[at - 1], size)]
        same[at] = ~np.logical_or.reduceat(differ, first)
    return same


def merge_runs(least: int):
    """Task: one sorted range of runs to the counts of its phrases and all their prefixes, languages included.

    Counts below `least` are left out, but for prefixes of the range's first and last rows, whose other parts may lie
    in other ranges, and for languages.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # by level: prefix, count so far, whether it is the first of the range
        open_: list[tuple[bytes, int, bool] | None] = [None] * (WORDS + 1)
        for batch in batches:
            data, offsets = flat(batch.column("key"))
            n = batch.column("n").to_numpy()
            if not len(n):
                continue
            found: list[tuple[bytes, int, int]] = []
            for level, length in enumerate(_ends(data, offsets)):
                has = np.flatnonzero(length > 0) if level else np.arange(len(n))
                if not len(has):
                    continue
                same = _same_as_before(data, offsets, length)
                starts = np.flatnonzero(~same[has])
                sums = np.add.reduceat(n[has], starts).tolist()
                rows = has[starts]

                def prefix(i: int) -> bytes:
                    r = int(rows[i])
                    return data[offsets[r] : offsets[r] + length[r]].tobytes()

                before, edge, last = open_[level], open_[level] is None, len(sums) - 1
                if before and before[0] == prefix(0):
                    sums[0] += before[1]
                    edge = before[2]
                elif before and (before[1] >= least or before[2]):
                    found.append((before[0], level, before[1]))
                if last:
                    whole = np.array(sums[:last]) >= (least if level else 0)
                    whole[0] |= edge
                    found += [(prefix(i), level, sums[i]) for i in np.flatnonzero(whole).tolist()]
                open_[level] = (prefix(last), sums[last], edge and not last)
            yield _counted(found)
        yield _counted([(o[0], level, o[1]) for level, o in enumerate(open_) if o])

    return work


def _counted(rows: list[tuple[bytes, int, int]]) -> pa.RecordBatch:
    keys = [[unescaped(part).decode() for part in key.split(b"\t")] for key, _, _ in rows]
    columns = [
        pa.array([k[0] for k in keys], pa.string()), pa.array([k[-1] if len(k) > 1 else None for k in keys], pa.string()),
        pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.int64()),
    ]
    return pa.RecordBatch.from_arrays(columns, names=["lang", "phrase", "words", "n"])


def phrase_runs(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """Sorted runs (key, n) of all tasks, written; a phrase may occur in several."""
    rows = docs.select(F.coalesce(F.col(lang), F.lit("und")).alias("lang"), F.col(text).alias("text"))
    # each text is written less what it shares with the one before
    front_coded = {"parquet.writer.version": "PARQUET_2_0", "parquet.enable.dictionary": "false", "compression": "zstd"}
    return written(rows.mapInArrow(count_runs, RUNS), "phrase-runs", **front_coded)


def frequent_phrases(runs: DataFrame, least: int = LEAST) -> DataFrame:
    """(lang, phrase, words, n) of all phrases of 1 to WORDS words that occur `least` times or more.

    A row of no words and a null phrase holds a language's number of words: every word begins one counted phrase.
    """
    ranges = runs.repartitionByRange("key").sortWithinPartitions("key")
    counts = ranges.mapInArrow(merge_runs(least), "lang string, phrase string, words int, n long")
    total = counts.groupBy("lang", "phrase", "words").agg(F.sum("n").alias("n"))
    return total.where((F.col("n") >= least) | (F.col("words") == 0))


def score_phrases(counts: DataFrame) -> DataFrame:
    """(lang, phrase, words, a, l, r, score) of the candidates that no longer one covers; counts hold all frequent phrases."""
    candidates = counts.where("words > 1").withColumnRenamed("n", "a").withColumn("w", F.split("phrase", " ", -1))
    k = F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k")
    cuts = candidates.select("lang", "phrase", "words", "a", "w", k).select(
        "lang", "phrase", "words", "a", "k",
        F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").alias("head"),
        F.array_join(F.slice("w", F.col("k") + 1, F.col("words") - F.col("k")), " ").alias("tail"),
    )
    heads = counts.select("lang", F.col("phrase").alias("head"), F.col("n").alias("l"))
    tails = counts.select("lang", F.col("phrase").alias("tail"), F.col("n").alias("r"))
    scored = cuts.join(heads, ["lang", "head"]).join(tails, ["lang", "tail"])
    score = F.expr("cast(2000000 as decimal(20,0)) * cast(a as decimal(18,0)) div cast(l + r as decimal(20,0))")
    lowest = scored.withColumn("score", score).groupBy("lang", "phrase").agg(
        F.first("words").alias("words"), F.first("a").alias("a"), F.min(F.struct("score", "k", "l", "r")).alias("cut")
    )
    size = F.explode(F.sequence(F.lit(2), F.col("words") - 1)).alias("size")
    inside = candidates.where("words > 2").select("lang", "words", "a", "w", size)
    inside = inside.select("lang", "a", "w", "size", F.explode(F.expr("sequence(1, words - size + 1)")).alias("from"))
    longer = inside.groupBy("lang", F.array_join(F.slice("w", F.col("from"), F.col("size")), " ").alias("phrase")).agg(
        F.max("a").alias("longer")
    )
    left = lowest.join(longer, ["lang", "phrase"], "left").where(
        f"longer is null or cast(100 as decimal(20,0)) * longer < cast({COVERS} as decimal(20,0)) * a"
    )
    return left.select("lang", "phrase", "words", "a", "cut.l", "cut.r", "cut.score")


def collocations(
    docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, top: int = TOP
) -> DataFrame:
    """Each language's first `top` phrases: lang, rank, phrase, a, l, r, n, score."""
    counts = written(frequent_phrases(phrase_runs(docs, text, lang), least), "phrases")
    words = broadcast_if_small(counts.where("words = 0").select("lang", "n"))
    scored = score_phrases(counts.where("words > 0")).withColumn(
        "rank", F.expr("cast(row_number() over (partition by lang order by score desc, a desc, phrase) as long)")
    )
    return scored.where(F.col("rank") <= top).join(words, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
