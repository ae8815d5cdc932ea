"""Language-model scores from a hierarchical Pitman-Yor model.

Tokens are words and one end per text. A token is drawn in the restaurant of its context, the two words
before it (or the start of the text). Restaurants of the same last word share a parent, and the parents
share the root, which draws from a uniform base over the words of the training texts and one more for all
others. A restaurant serves a word's customers at tables; each table is one customer of the parent. Seating
is sampled by Gibbs: a sweep unseats, level by level, all customers of a word in a restaurant and seats them
again one by one given all others (beyond ``SINGLE`` customers in blocks of a sixteenth of those seated, with
the chance held within a block). Predictive probabilities are averaged over ``SAMPLES`` sweeps after ``BURN_IN``.

Scale: a parent and all restaurants below it are in one shard, so their totals never leave it. A word that
more than ``HOT_TOKENS`` tokens follow has a parent for each so many tokens, by a hash of the word before it, so
the tokens of a shard are bounded but for a single context's, which are summed per word; the number
of shards comes from the words counted in a first pass. Only the root is spread over shards: after each
sweep a shard tells how many tables each of its words has, words are summed and seated at the root by hash,
and the shard is told the outcome (a sweep sees the root as of the sweep before). The driver sees sums of
whole levels, and the ``COMMON`` most frequent words, which stand for themselves as short codes wherever
words are stored or sent; only rarer ones go as hashes. A block of texts sends each shard its distinct
(context, word) entries and where its texts have them, once. A shard keeps both in a file of the shared
folder, and later stages send its name, the seating of the sweep before and the root's answers; at the end a
shard sums the tokens of a text that it has. Shuffles are given up as soon as what they made is written.

Defined cases: a null or empty text is its end alone. Rows that share an id are scored each and count
each; a null ``doc_id`` is scored and trains nothing (its fold is unknown). With no training text, all
words are unknown. An empty table gives no rows. Other columns are left aside. Words and contexts are
compared by 64-bit hashes, ASCII letters in lower case; texts are read whole.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retailtide.llm.components import written
from retailtide.llm.files import new_file, opened, tasks_for
from retailtide.llm.texts import Texts, mix, slices
from retailtide.session import shared_folder

BLOCK_TOKENS = 1_000_000
SHARD_TOKENS = 2_000_000
#: About the size of a shard's file.
SHARD_BYTES = 10 * 2**20
HOT_TOKENS = 500_000
#: Words that have codes.
COMMON = 1 << 19
BURN_IN, SAMPLES = 1, 3
SINGLE = 64
STRENGTH = 1.0
FOLDS = 10
#: Restaurants of a shard that names none: contexts of 16 bits, whose low bytes are their parents.
_LEAVES, _PARENTS = 65536, 256
#: Line feeds are in no word, so they stand for the start and the end of a text.
_END, _START = mix(np.array([0x0A, 0x0A0A], np.uint64))
_STEP = np.uint64(0x9E3779B97F4A7C15)

_PARTS = "block long, shard long, message binary, texts binary"


def held_out(folds: int = FOLDS):
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % folds == 0, F.lit(True))


def tokens_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all tokens, of the words one and two before them, and how many tokens each text has."""
    t = Texts(column, lower=True)
    lengths = t.n_words + 1
    words = np.full(len(t.starts) + len(t), _END, np.uint64)
    words[np.arange(len(t.starts)) + np.repeat(np.arange(len(t)), t.n_words)] = t.hashes()
    begins = np.cumsum(lengths) - lengths
    one, two = np.full(len(words), _START, np.uint64), np.full(len(words), _START, np.uint64)
    one[1:], two[2:] = words[:-1], words[:-2]
    one[begins] = two[begins] = _START
    two[begins[lengths > 1] + 1] = _START
    return words, one, two, lengths


def _plain(values: np.ndarray) -> tuple:
    """Integers in as few bytes as the largest needs, first all low bytes, then all next ones: these compress."""
    if values.dtype.kind == "f":
        return 0, values
    kind = np.uint64 if values.dtype == np.uint64 else np.int64
    width = 8
    if len(values) and values.min() >= 0:
        width = max(1, -(-int(values.max()).bit_length() // 8))
    return width, kind, np.ascontiguousarray(values, kind).view(np.uint8).reshape(-1, 8)[:, :width].T.copy()


def _packed(*arrays: np.ndarray) -> bytes:
    plain = pickle.dumps([_plain(np.asarray(a)) for a in arrays], 5)
    return len(plain).to_bytes(8, "little") + pa.compress(plain, codec="zstd", asbytes=True)


def _unpacked(value: bytes) -> list[np.ndarray]:
    size = int.from_bytes(value[:8], "little")
    out = []
    for width, *rest in pickle.loads(pa.decompress(value[8:], size, codec="zstd", asbytes=True)):
        if not width:
            out.append(rest[0])
            continue
        kind, planes = rest
        wide = np.zeros((planes.shape[1], 8), np.uint8)
        wide[:, :width] = planes.T
        out.append(wide.reshape(-1).view(kind))
    return out


def _steps(values: np.ndarray) -> np.ndarray:
    return np.diff(values, prepend=0)


def _joined(pieces: list[bytes]) -> bytes:
    return b"".join(len(p).to_bytes(8, "little") + p for p in pieces)


def _split(value: bytes, at: int = 0) -> Iterator[bytes]:
    while at < len(value):
        size = int.from_bytes(value[at : at + 8], "little")
        yield value[at + 8 : at + 8 + size]
        at += 8 + size


@dataclass
class _Known:
    """What the first pass tells: hot words, ascending, with the number of their parents; common words, most
    frequent first, with their training counts; and the tokens and distinct words of the training texts."""

    words: np.ndarray
    parents: np.ndarray
    common: np.ndarray
    counts: np.ndarray
    tokens: int
    types: int

    def parent_of(self, one: np.ndarray, two: np.ndarray) -> np.ndarray:
        """The parent of each context."""
        at, hot = _found(self.words, one)
        parent = one.copy()
        if hot.any():
            number = mix(two[hot]) % self.parents[at[hot]].astype(np.uint64) + np.uint64(1)
            parent[hot] = mix(one[hot] + number * _STEP)
        return parent

    def base(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 0.1) / (self.tokens + 0.1 * (self.types + 1)))

    def coded(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes of distinct words, and the words without one, ascending, whose codes come behind."""
        if not hasattr(self, "_order"):
            self._order = np.argsort(self.common)
            self._sorted = self.common[self._order]
        at, has = _found(self._sorted, words)
        rare = np.sort(words[~has])
        codes = len(self.common) + np.searchsorted(rare, words)
        codes[has] = self._order[at[has]]
        return codes, rare

    def told(self, codes: np.ndarray, rare: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes with only those of the rare words behind them that occur, and these."""
        used = np.zeros(len(rare), bool)
        behind = codes >= len(self.common)
        used[codes[behind] - len(self.common)] = True
        codes = codes.copy()
        codes[behind] = len(self.common) + (np.cumsum(used) - 1)[codes[behind] - len(self.common)]
        return codes, rare[used]

    def hashes(self, codes: np.ndarray, rare: np.ndarray) -> np.ndarray:
        return np.concatenate([self.common, rare])[codes]

    def recoded(self, codes: np.ndarray, rare: np.ndarray, all_rare: np.ndarray) -> np.ndarray:
        """Codes with the rare words behind them, as codes with all of ``all_rare`` behind them."""
        out = codes.copy()
        behind = codes >= len(self.common)
        out[behind] = len(self.common) + np.searchsorted(all_rare, rare)[codes[behind] - len(self.common)]
        return out


def _frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words of a block, with how many tokens and training tokens each has."""

    def counted(parts: list) -> pa.RecordBatch:
        tokens = np.concatenate([w for w, _ in parts])
        words, counts = np.unique(tokens, return_counts=True)
        known, times = np.unique(tokens[np.concatenate([t for _, t in parts])], return_counts=True)
        train = np.zeros(len(words), np.int64)
        train[np.searchsorted(words, known)] = times
        columns = [words.view(np.int64), counts, train]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["word", "tokens", "train"])

    parts, size = [], 0
    for batch in batches:
        for part in slices(batch, "text"):
            words, _, _, lengths = tokens_of(part.column("text"))
            held = part.column("held").to_numpy(zero_copy_only=False).astype(bool)
            parts.append((words, np.repeat(~held, lengths)))
            size += len(words)
            if size >= BLOCK_TOKENS:
                yield counted(parts)
                parts, size = [], 0
    if size:
        yield counted(parts)


def _dealt(rows: DataFrame) -> tuple[int, _Known]:
    """The number of shards, and what is known of words; rows without ``held`` are all for training.

    A word is followed by as many tokens as it has itself, the start of a text by as many as there are ends.
    """
    held = F.col("held") if "held" in rows.columns else F.lit(False)
    words = written(
        rows.select("text", held.alias("held")).mapInArrow(_frequent, "word long, tokens long, train long")
        .groupBy("word").agg(F.sum("tokens").alias("tokens"), F.sum("train").alias("train")),
        "lm-words",
    )
    count = lambda c: F.coalesce(F.sum(c), F.lit(0))
    sums = words.agg(
        count("tokens").alias("all"), count("train").alias("train"), F.count_if(F.col("train") > 0).alias("types")
    ).first()
    hot = words.filter(F.col("tokens") > HOT_TOKENS).select("word", "tokens").toArrow()
    hashes = hot.column("word").to_numpy().view(np.uint64).copy()
    hashes[hashes == _END] = _START
    order = np.argsort(hashes)
    parents = -(-hot.column("tokens").to_numpy() // HOT_TOKENS)
    common = words.orderBy(F.col("tokens").desc(), "word").limit(COMMON).select("word", "train").toArrow()
    names = np.append(common.column("word").to_numpy().view(np.uint64), _START)
    counts = np.append(common.column("train").to_numpy(), 0)
    known = _Known(hashes[order], parents[order], names, counts, sums["train"], sums["types"])
    return max(1, -(-sums["all"] // SHARD_TOKENS)), known


@dataclass
class _Block:
    words: list = field(default_factory=list)
    one: list = field(default_factory=list)
    two: list = field(default_factory=list)
    lengths: list = field(default_factory=list)
    doc_ids: list = field(default_factory=list)
    held: list = field(default_factory=list)

    def rows(self, number: int, shards: int, known: _Known) -> pa.RecordBatch:
        """The block's own row, and a message to each shard that has contexts of it."""
        words, one, two = (np.concatenate(x) for x in (self.words, self.one, self.two))
        lengths, held = np.concatenate(self.lengths), np.concatenate(self.held)
        distinct, at = np.unique(np.append(words, _START), return_inverse=True)
        codes, rare = known.coded(distinct)
        word, start = codes[at[:-1]], codes[at[-1]]
        begins = np.cumsum(lengths) - lengths
        up = np.append(at[-1], at[:-2])
        up[begins] = at[-1]
        before = codes[up]
        # The parent of a word is the word itself, but for hot ones.
        parent, hot = distinct, np.isin(distinct, known.words)[up]
        if hot.any():
            several = known.parent_of(one[hot], two[hot])
            parent = np.union1d(distinct, several)
            up = np.searchsorted(parent, distinct)[up]
            up[hot] = np.searchsorted(parent, several)
        two = np.append(start, before[:-1])
        two[begins] = start
        size = len(known.common) + len(rare)
        # Entries by shard, parent (by its hash), second word before and word, as the shard will have them.
        contexts, context = _distinct(up * size + two)
        entries, entry = _distinct(context * size + word)
        # Numbers of two bytes are sorted by their digits.
        shard = shard_of(parent, shards).astype(np.uint16 if shards <= 1 << 16 else np.int32)
        shard = shard[(contexts // size)[entries // size]]
        order = np.argsort(shard, kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        entry, entries, shard = rank[entry], entries[order], shard[order]
        counts = np.bincount(entry[~np.repeat(held, lengths)], minlength=len(order))
        last = np.zeros(len(parent), np.int64)
        last[up] = before
        owner = np.repeat(np.arange(len(lengths)), lengths)
        pairs = np.sort(owner << 32 | entry)
        owner, entry = pairs >> 32, pairs & 0xFFFFFFFF
        order = np.argsort(shard[entry], kind="stable")
        owner, entry = owner[order], entry[order]
        token_shard = shard[entry]
        is_common = word < len(known.common)
        count = np.where(is_common, known.counts[np.where(is_common, word, 0)], 0)
        base = np.add.reduceat(np.where(is_common, known.base(count), 0.0), begins)
        own = pickle.dumps([i for part in self.doc_ids for i in part])
        out = [(number, -1 - number, own, _packed(held, lengths, np.add.reduceat((count > 0).astype(np.int64), begins), base))]
        for s in np.unique(shard).tolist():
            a, b = np.searchsorted(shard, (s, s + 1))
            in_context, word = np.divmod(entries[a:b], size)
            first = np.flatnonzero(_changes(in_context))
            in_parent, two = np.divmod(contexts[in_context[first]], size)
            new = np.flatnonzero(_changes(in_parent))
            told, own_rare = known.told(np.concatenate([word, last[in_parent[new]], two]), rare)
            word, ones, two = np.split(told, np.cumsum([len(word), len(new)]))
            sizes = np.diff(first, append=b - a), np.diff(new, append=len(first))
            c, d = np.searchsorted(token_shard, (s, s + 1))
            texts = np.flatnonzero(_changes(owner[c:d]))
            steps = _steps(entry[c:d] - a)
            steps[texts] = entry[c:d][texts] - a
            out.append(
                (number, s, _packed(own_rare, word, ones, two, *sizes, counts[a:b]),
                 _packed(_steps(owner[c:d][texts]), np.diff(texts, append=d - c), steps))
            )
        kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary()]
        names = [name.split()[0] for name in _PARTS.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)


def _changes(values: np.ndarray) -> np.ndarray:
    new = np.ones(len(values), bool)
    new[1:] = values[1:] != values[:-1]
    return new


def _distinct(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ones of numbers from 0, ascending, and the place of each number among them.

    Where a number and its own place fit 8 bytes these are sorted, which takes a fraction of sorting places.
    """
    bits = len(values).bit_length()
    if not len(values) or int(values.max()).bit_length() + bits > 63:
        return np.unique(values, return_inverse=True)
    both = np.sort(values << bits | np.arange(len(values)))
    ordered = both >> bits
    new = _changes(ordered)
    place = np.empty(len(values), np.int64)
    place[both & ((1 << bits) - 1)] = np.cumsum(new) - 1
    return ordered[new], place


def leaf_of(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    return mix(two * _STEP + one)


def shard_of(hashes: np.ndarray, shards: int) -> np.ndarray:
    return (mix(hashes) % np.uint64(shards)).astype(np.int32)


def _blocks(shards: int, shared: Broadcast):
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        number = TaskContext.get().partitionId() << 32
        block, size = _Block(), 0
        for batch in batches:
            for part in slices(batch, "text"):
                words, one, two, lengths = tokens_of(part.column("text"))
                block.words.append(words)
                block.one.append(one)
                block.two.append(two)
                block.lengths.append(lengths)
                block.doc_ids.append(part.column("doc_id").to_pylist())
                block.held.append(part.column("held").to_numpy(zero_copy_only=False).astype(bool))
                size += len(words)
                if size >= BLOCK_TOKENS:
                    yield block.rows(number, shards, known)
                    number, block, size = number + 1, _Block(), 0
        if size:
            yield block.rows(number, shards, known)

    return make


@dataclass
class Totals:
    """Customers and tables of a shard's restaurants and of the root, and the model's parameters."""

    leaf: np.ndarray
    leaf_tables: np.ndarray
    parent: np.ndarray
    parent_tables: np.ndarray
    root: float
    root_tables: float
    discounts: tuple[float, float, float]
    types: int


@dataclass
class Root:
    """What all shards share after a sweep."""

    customers: float
    tables: float
    discounts: tuple[float, float, float]
    types: int

    def probabilities(self, customers: np.ndarray, seats: np.ndarray) -> np.ndarray:
        d0 = self.discounts[2]
        own = customers - d0 * seats + (STRENGTH + d0 * self.tables) / (self.types + 1)
        return own / (STRENGTH + self.customers)


@dataclass
class Shard:
    """The training counts of a shard: entries of a word in a context; ``up`` has each entry's parent."""

    words: np.ndarray
    word: np.ndarray
    context: np.ndarray
    count: np.ndarray
    up: np.ndarray | None = None
    leaves: int = _LEAVES
    parents: int = _PARENTS

    def __post_init__(self):
        up = self.context & 0xFF if self.up is None else self.up
        self.parent_keys, self.parent = _distinct(self.word * self.parents + up)
        self.parent_word = self.parent_keys // self.parents
        self.parent_context = self.parent_keys % self.parents
        self.seats = np.ones(len(self.count), np.int64)
        self.parent_seats = np.ones(len(self.parent_keys), np.int64)
        self.root_seats = np.ones(len(self.words), np.int64)

    def parent_customers(self) -> np.ndarray:
        return np.bincount(self.parent, self.seats, len(self.parent_keys)).astype(np.int64)

    def root_customers(self) -> np.ndarray:
        return np.bincount(self.parent_word, self.parent_seats, len(self.words)).astype(np.int64)

    def totals(self, root: Root) -> Totals:
        return Totals(
            np.bincount(self.context, self.count, self.leaves),
            np.bincount(self.context, self.seats, self.leaves),
            np.bincount(self.parent_context, self.parent_customers(), self.parents),
            np.bincount(self.parent_context, self.parent_seats, self.parents),
            root.customers,
            root.tables,
            root.discounts,
            root.types,
        )

    def probabilities(self, totals: Totals, root: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Of the words at the root (if not given, of this shard alone), and of the entries' words at their parents."""
        _, d1, _ = totals.discounts
        if root is None:
            whole = Root(totals.root, totals.root_tables, totals.discounts, totals.types)
            root = whole.probabilities(self.root_customers(), self.root_seats)
        own = self.parent_customers() - d1 * self.parent_seats
        share = STRENGTH + d1 * totals.parent_tables[self.parent_context]
        parent = (own + share * root[self.parent_word]) / (STRENGTH + totals.parent[self.parent_context])
        return root, parent

    def sweep(self, totals: Totals, random: np.random.Generator, root: np.ndarray | None = None) -> None:
        """Seat all customers anew, from the leaves up, also at the root if its probabilities are not given."""
        d2, d1, d0 = totals.discounts
        alone = root is None
        root, parent = self.probabilities(totals, root)
        others = np.maximum(totals.leaf_tables[self.context] - self.seats, 0)
        chance = parent[self.parent]
        self.seats = seated(self.count, (STRENGTH + d2 * others) * chance, d2, chance, random)
        others = np.maximum(totals.parent_tables[self.parent_context] - self.parent_seats, 0)
        chance = root[self.parent_word]
        self.parent_seats = seated(
            self.parent_customers(), (STRENGTH + d1 * others) * chance, d1, chance, random
        )
        if alone:
            self.root_seats = root_seated(
                self.root_customers(), self.root_seats, totals.root_tables, d0, totals.types, random
            )

    def counted(self) -> pd.DataFrame:
        """The customers and tables of this shard, a row per restaurant."""
        levels = (
            (2, self.context, self.count, self.seats, self.leaves),
            (1, self.parent_context, self.parent_customers(), self.parent_seats, self.parents),
            (0, np.zeros(len(self.words), np.int64), self.root_customers(), self.root_seats, 1),
        )
        frames = []
        for level, context, customers, tables, size in levels:
            sums = [np.bincount(context, w, size) for w in (customers, tables)]
            used = np.flatnonzero(sums[0])
            columns = {n: s[used].astype(np.int64) for n, s in zip(("customers", "tables"), sums)}
            frames.append(pd.DataFrame({"level": level, "context": used} | columns))
        return pd.concat(frames)


def root_seated(customers, seats, tables: float, discount: float, types: int, random) -> np.ndarray:
    """Tables at the root of words that had ``seats`` of its ``tables``."""
    base = np.full(len(customers), 1 / (types + 1))
    others = np.maximum(tables - seats, 0)
    return seated(customers, (STRENGTH + discount * others) * base, discount, base, random)


def seated(customers: np.ndarray, mass: np.ndarray, discount: float, chance: np.ndarray, random) -> np.ndarray:
    """Tables that so many customers of a word take, seated one after another.

    ``mass`` is the weight of a new table before any is taken here; each that is taken adds
    ``discount * chance`` to it, as the restaurant has one more.
    """
    tables = np.minimum(customers, 1).astype(np.int64)
    several = np.flatnonzero(customers > 1)
    order = several[np.argsort(-customers[several], kind="stable")]
    sizes = customers[order]
    at = 1
    while True:
        active = int(np.searchsorted(-sizes, -at, side="left"))  # those with more than ``at`` customers
        if not active:
            return tables
        who = order[:active]
        step = 1 if at < SINGLE else at // 16
        new = mass[who] + discount * (tables[who] - 1) * chance[who]
        share = new / (new + at - discount * tables[who])
        if step == 1:
            tables[who] += random.random(active) < share
        else:
            tables[who] += random.binomial(np.minimum(step, sizes[:active] - at), share)
        at += step


def _merging(shared: Broadcast, folder: str):
    """Writes a shard's file: its model, and per block its entries and texts. A block's own row passes."""

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        number = int(group["shard"].iloc[0])
        if number < 0:
            return group[["shard", "message", "texts"]].rename(columns={"message": "name"})
        known = shared.value
        group = group.sort_values("block")
        told = [_unpacked(message) for message in group["message"]]
        all_rare = np.unique(np.concatenate([t[0] for t in told]))
        size = len(known.common) + len(all_rare)
        hashes = np.concatenate([known.common, all_rare])
        words, parents, ups, twos, sizes, counts = [], [], [], [], [], []
        for own_rare, word, ones, two, in_context, in_parent, count in told:
            word, ones, two = (known.recoded(x, own_rare, all_rare) for x in (word, ones, two))
            words.append(word)
            parents.append(known.parent_of(hashes[ones], hashes[two[np.cumsum(in_parent) - in_parent]]))
            ups.append(in_parent)
            twos.append(two)
            sizes.append(in_context)
            counts.append(count)
        del told
        lengths = [len(w) for w in words]
        _, up = np.unique(np.concatenate(parents), return_inverse=True)
        up = np.repeat(up, np.concatenate(ups))
        contexts, context = _distinct(up * size + np.concatenate(twos))
        context = np.repeat(context, np.concatenate(sizes))
        entries, entry = _distinct(context * size + np.concatenate(words))
        count = np.bincount(entry, np.concatenate(counts), len(entries)).astype(np.int64)
        context, word = np.divmod(entries, size)
        used = np.zeros(size, bool)
        used[word] = True
        codes, rare = known.told(np.flatnonzero(used), all_rare)
        model = _packed(
            rare, _steps(codes), (np.cumsum(used) - 1)[word], np.bincount(context), np.bincount(contexts // size), count
        )
        name, out = new_file(folder, ".shard")
        with out:
            out.write(_joined([model]))
            for block, texts, own in zip(group["block"], group["texts"], np.split(entry, np.cumsum(lengths)[:-1])):
                out.write(_joined([pickle.dumps(block), _packed(_steps(own)), texts]))
        return pd.DataFrame({"shard": [number], "name": [name.encode()], "texts": [None]})

    return merge


@dataclass
class _Model:
    """A shard's words, by their codes, and its entries, also those that are in no training text."""

    codes: np.ndarray
    rare: np.ndarray
    word: np.ndarray
    context: np.ndarray
    up: np.ndarray
    count: np.ndarray
    contexts: int
    parents: int

    def shard(self, hashes: np.ndarray) -> Shard:
        train = self.count > 0
        parts = self.word[train], self.context[train], self.count[train], self.up[train]
        return Shard(hashes, *parts, self.contexts, self.parents)


def _model(value: bytes) -> _Model:
    rare, steps, word, in_context, in_parent, count = _unpacked(value)
    context = np.repeat(np.arange(len(in_context)), in_context)
    up = np.repeat(np.arange(len(in_parent)), in_parent)[context]
    return _Model(np.cumsum(steps), rare, word, context, up, count, len(in_context), len(in_parent))


def _file(name: bytes, whole: bool) -> list[bytes]:
    """A shard's model, and if it is to be whole, per block its number, entries and texts."""
    system, path = opened(bytes(name).decode())
    with system.open_input_file(path) as source:
        if whole:
            return list(_split(source.read()))
        return [source.read(int.from_bytes(source.read(8), "little"))]


def _seating(shard: Shard) -> bytes:
    """The tables of all that have more than one customer; others have one."""
    return _packed(shard.seats[shard.count > 1], shard.parent_seats[shard.parent_customers() > 1])


def _seat_again(shard: Shard, seating: bytes) -> None:
    seats, parent_seats = _unpacked(seating)
    shard.seats = np.ones(len(shard.count), np.int64)
    shard.seats[shard.count > 1] = seats
    shard.parent_seats = np.ones(len(shard.parent_keys), np.int64)
    shard.parent_seats[shard.parent_customers() > 1] = parent_seats


#: A shard's file (round -1), its seating after a round (root -1), or what the root shard ``root`` answered it then.
_TOLD = "shard int, round int, root int, data binary"


def _answer(rows: pd.DataFrame, number: int, at_root: np.ndarray) -> np.ndarray:
    """Per word of the shard, its customers and tables at the root after a round."""
    answer = np.zeros((2, len(at_root)), np.int64)
    told = rows[(rows["round"] == number) & (rows["root"] >= 0)]
    for root, data in zip(told["root"], told["data"]):
        answer[:, at_root == root] = _unpacked(data)
    return answer


def _seated_after(rows: pd.DataFrame, number: int) -> bytes:
    return rows["data"][(rows["round"] == number) & (rows["root"] < 0)].iloc[0]


_COUNTED = "shard int, root int, data binary, once2 long, twice2 long, once1 long, twice1 long"


def _counting(number: int, history: list[Root], shards: int, shared: Broadcast):
    """Per shard, a sweep if the root has answered; then a message to each root shard with the tables of its
    words, and a row with its seating and what discounts need."""

    def count(rows: pd.DataFrame) -> pd.DataFrame:
        known = shared.value
        own_number = int(rows["shard"].iloc[0])
        model = _model(_file(rows["data"][rows["round"] < 0].iloc[0], False)[0])
        hashes = known.hashes(model.codes, model.rare)
        shard, at_root = model.shard(hashes), shard_of(hashes, shards)
        codes, all_rare = model.codes, model.rare
        del model
        seats = np.zeros(len(hashes), np.int64)
        if number:
            customers, seats = _answer(rows, number - 1, at_root)
            _seat_again(shard, _seated_after(rows, number - 1))
            root = history[number - 1]
            random = np.random.Generator(np.random.PCG64([own_number, number - 1]))
            shard.sweep(shard.totals(root), random, root.probabilities(customers, seats))
        tables = shard.root_customers()
        out = []
        for root in np.unique(at_root).tolist():
            own = at_root == root
            told, rare = known.told(codes[own], all_rare)
            out.append((own_number, root, _packed(rare, _steps(told), tables[own], seats[own]), 0, 0, 0, 0))
        customers = shard.parent_customers()
        sums = [int((c == n).sum()) for c in (shard.count, customers) for n in (1, 2)]
        out.append((own_number, -1 - own_number, _seating(shard), *sums))
        return pd.DataFrame(out, columns=[c.split()[0] for c in _COUNTED.split(", ")])

    return count


_SUMS = ("customers", "tables", "once", "twice", "once2", "twice2", "once1", "twice1")
_ROOTED = f"{_TOLD}, " + ", ".join(f"{name} long" for name in _SUMS)


def _rooting(number: int, before: Root | None, shared: Broadcast):
    """Sum and seat the words of a root shard; each shard is told of its own words. A seating passes."""

    def seat(group: pd.DataFrame) -> pd.DataFrame:
        out = pd.DataFrame({"shard": group["shard"], "round": number, "root": group["root"], "data": group["data"]})
        for name in _SUMS:
            out[name] = group[name] if name in group else 0
        if group["root"].iloc[0] < 0:
            return out.assign(root=-1)
        known = shared.value
        told = [_unpacked(d) for d in group["data"]]
        all_rare = np.unique(np.concatenate([t[0] for t in told]))
        codes = np.concatenate([known.recoded(np.cumsum(t[1]), t[0], all_rare) for t in told])
        words, inverse = np.unique(codes, return_inverse=True)
        customers = np.bincount(inverse, np.concatenate([t[2] for t in told])).astype(np.int64)
        seats = np.minimum(customers, 1)
        if before:
            held = np.zeros(len(words), np.int64)
            held[inverse] = np.concatenate([t[3] for t in told])
            random = np.random.Generator(np.random.PCG64([int(group["root"].iloc[0]), number, 1]))
            seats = root_seated(customers, held, before.tables, before.discounts[2], before.types, random)
        ends = np.cumsum([len(t[1]) for t in told])
        out["data"] = [_packed(customers[at], seats[at]) for at in np.split(inverse, ends[:-1])]
        first = np.arange(len(out)) == 0
        for name, value in zip(_SUMS, (customers.sum(), seats.sum(), (customers == 1).sum(), (customers == 2).sum())):
            out[name] = np.where(first, value, 0)
        return out

    return seat


def _discount(once: int, twice: int) -> float:
    return min(0.95, max(0.05, once / (once + 2 * twice))) if once else 0.5


def _sums(rows: DataFrame, *names: str) -> dict[str, int]:
    return rows.agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names]).first().asDict()


def _answers(rows: pd.DataFrame, history: list[Root], shards: int, known: _Known) -> pd.DataFrame:
    """For each block the sums over what this shard has of its texts: log10 probabilities, and for words
    without a code also the base and how many are in training."""
    number = int(rows["shard"].iloc[0])
    packed, *parts = _file(rows["data"][rows["round"] < 0].iloc[0], True)
    model = _model(packed)
    hashes = known.hashes(model.codes, model.rare)
    shard, at_root = model.shard(hashes), shard_of(hashes, shards)
    train = model.count > 0
    middle, has_middle = np.zeros(len(train), np.int64), train.copy()
    middle[train] = shard.parent
    middle[~train], has_middle[~train] = _found(shard.parent_keys, (model.word * shard.parents + model.up)[~train])
    total = np.zeros(len(model.word))
    for sweep in range(BURN_IN + 1, len(history)):
        root = history[sweep]
        d2, d1, _ = root.discounts
        _seat_again(shard, _seated_after(rows, sweep))
        totals = shard.totals(root)
        p = root.probabilities(*_answer(rows, sweep, at_root))[model.word]
        own = np.zeros(len(p))
        if len(shard.parent_keys):
            own = np.where(has_middle, (shard.parent_customers() - d1 * shard.parent_seats)[middle], 0.0)
        p = own + (STRENGTH + d1 * totals.parent_tables[model.up]) * p
        p /= STRENGTH + totals.parent[model.up]
        p *= STRENGTH + d2 * totals.leaf_tables[model.context]
        p[train] += shard.count - d2 * shard.seats
        total += p / (STRENGTH + totals.leaf[model.context])
    score = np.log10(total / (len(history) - BURN_IN - 1))
    count = np.bincount(model.word, model.count, len(hashes))
    rare = (model.codes >= len(known.common))[model.word]
    out = []
    for block, own, texts in zip(parts[::3], parts[1::3], parts[2::3]):
        own = np.cumsum(_unpacked(own)[0])
        text, sizes, steps = _unpacked(texts)
        begins = np.cumsum(sizes) - sizes
        sums = np.cumsum(steps)
        # Within a text the entries are ascending, so their steps add up to them.
        entry = own[sums - np.repeat(sums[begins] - steps[begins], sizes)]
        is_rare = rare[entry]
        text = np.cumsum(text)
        others = np.repeat(text, sizes)[is_rare]
        where, at = np.unique(others, return_inverse=True)
        counts = count[model.word[entry[is_rare]]]
        data = _packed(
            _steps(text), np.add.reduceat(score[entry], begins).astype(np.float32),
            _steps(where), np.bincount(at, counts > 0).astype(np.int64), np.bincount(at, known.base(counts)),
        )
        out.append((pickle.loads(block), number, data))
    return pd.DataFrame(out, columns=["block", "shard", "data"])


def _found(sorted_values: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of values in a sorted array, and whether they are there."""
    if not len(sorted_values):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(sorted_values, wanted), len(sorted_values) - 1)
    return at, sorted_values[at] == wanted


_SCORED = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long,"
    " base_score double, score double"
)


def _summed(train_tokens: int):
    def block(blocks: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        row = blocks.iloc[0]
        held, lengths, known, base = _unpacked(row["texts"])
        score = np.zeros(len(lengths))
        for data in answers.sort_values("shard")["data"]:
            text, sums, others, more, bases = _unpacked(data)
            score[np.cumsum(text)] += sums
            others = np.cumsum(others)
            known[others] += more
            base[others] += bases
        return pd.DataFrame(
            {
                "doc_id": pd.array(pickle.loads(row["name"]), dtype="Int64"),
                "held_out": held.astype(bool),
                "n_tokens": lengths,
                "n_known": known,
                "train_tokens": train_tokens,
                "base_score": base,
                "score": score,
            }
        )

    return block


@contextmanager
def _shuffles_given_up(spark: SparkSession):
    """Spark deletes the shuffles of a job when it ends; for jobs whose whole outcome is written."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def score(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Per document row the columns of ``op7``: counts, ``base_score`` and ``score``, in log10."""
    with _shuffles_given_up(docs.sparkSession):
        return _score(docs.sparkSession, docs)


def _score(spark: SparkSession, docs: DataFrame) -> DataFrame:
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    ).withColumn("held", held_out())
    shards, known = _dealt(rows)
    shared = spark.sparkContext.broadcast(known)
    parts = rows.mapInArrow(_blocks(shards, shared), _PARTS)
    merge = _merging(shared, shared_folder(spark, "lm-shards"))
    model = written(parts.groupBy("shard").applyInPandas(merge, "shard long, name binary, texts binary"), "lm-model")
    none = F.lit(-1).cast("int")
    columns = [c.split()[0] for c in _TOLD.split(", ")]
    files = model.filter("shard >= 0").select(
        F.col("shard").cast("int").alias("shard"), none.alias("round"), none.alias("root"), F.col("name").alias("data")
    )
    # Rows are small but a shard's file is not, so tasks are dealt by the files that they read.
    tasks = tasks_for(spark, shards, shards * SHARD_BYTES)
    dealt = lambda told: told.repartition(tasks, "shard")
    history: list[Root] = []
    answered: list[DataFrame] = []
    for number in range(1 + BURN_IN + SAMPLES):
        asked = dealt(files.union(answered[-1]) if answered else files)
        counted = asked.groupBy("shard").applyInPandas(_counting(number, list(history), shards, shared), _COUNTED)
        seat = _rooting(number, history[-1] if history else None, shared)
        rooted = written(counted.groupBy("root").applyInPandas(seat, _ROOTED), "lm-root")
        r = _sums(rooted, *_SUMS)
        discounts = (
            _discount(r["once2"], r["twice2"]), _discount(r["once1"], r["twice1"]), _discount(r["once"], r["twice"])
        )
        history.append(Root(float(r["customers"]), float(r["tables"]), discounts, known.types))
        answered.append(rooted.select(columns))
    whole = files
    for told in answered[BURN_IN + 1 :]:
        whole = whole.union(told)
    answers = dealt(whole).groupBy("shard").applyInPandas(
        lambda told: _answers(told, history, shards, shared.value), "block long, shard int, data binary"
    )
    blocks = model.filter("shard < 0").select((-1 - F.col("shard")).alias("block"), "name", "texts")
    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(_summed(known.tokens), _SCORED)


def perplexity(scored: DataFrame) -> DataFrame:
    """Per fold: tokens, and the perplexity of the model and of the base."""
    per_token = lambda name: F.pow(F.lit(10.0), -F.sum(name) / F.sum("n_tokens"))
    return scored.groupBy("held_out").agg(
        F.sum("n_tokens").alias("n_tokens"),
        per_token("score").alias("perplexity"),
        per_token("base_score").alias("base_perplexity"),
    )
