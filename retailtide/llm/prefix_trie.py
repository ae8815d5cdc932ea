"""The trie of all openings that conversations share, from vertical bitmaps.

A node is a distinct sequence of first turns, from the root without turns. Conversations with equal
turns become one sequence with a weight first, so copies cost no more than one. Sequences are dealt to
shards by their opening: the first turn, and as many more as it takes until at most ``SHARD`` sequences share
it, so a first turn that a third of the conversations have is split by the turns after it. A shard indexes
(position, turn) to a bitset of its sequences, and weights by their binary digits. It then goes depth
first: the bitset of a node and the posting of a turn at the next position give a child, population
counts of the result with the digits of the weights its members, and what has no next turn ends there.
Openings above the shards ("heads") are few; they are added up from one row per shard and sequence.

A node's conversations that end in it are hashed in ascending order in one pass over lists of at most
``CHUNK`` ids each.

Defined cases: rows without a ``conv_id`` are left out; null roles and texts are empty; turns with one number
are ordered by the hash of role and text; rows repeated in a conversation are turns of their own. An empty
table has no node, not even a root. Only ``conv_id``, ``turn``, ``role`` and ``text`` are read, so other
columns may have any name. The turns of one conversation are held by one task, as hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retailtide.llm.components import written
from retailtide.operators.bounded import broadcast_if_small

WORD = r"[^\x20\x09-\x0D]+"

#: Sequences with one opening that a shard takes; with more it is split.
SHARD = 1024

#: Sequences of a task, of whole shards.
TASK_SEQUENCES = 20_000

#: Range of the ids in one list of ends.
CHUNK = 32_768

ROOT = hashlib.sha256(b"").digest()
_EMPTY = hashlib.sha256(b"").hexdigest()
_ARROW_ROWS = 4096

_PATHS = "conv_id long, seq binary, keys array<binary>, words array<long>"
_PREFIXES = "seq binary, prefix binary"
_SEQUENCES = "seq binary, n long, first long, keys array<binary>, words array<long>, heads int"
_NODES = (
    "node binary, above binary, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
    "n_leaves long, saved_tokens long, ended boolean"
)
_SHARES = "node binary, depth long, last_words long, n long, conv_id long, leaves long, saved long, children long"
_OWN = "node binary, own long, children long, of binary, above binary"


def turn_lists(conversations: DataFrame) -> DataFrame:
    """``conv_id, turns``: the turns of each conversation in order, as hashes with counts of words."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    whole = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    rows = conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(
            F.col("turn"),
            F.unhex(F.sha2(whole, 256)).alias("key"),
            F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
        ).alias("t"),
    )
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))


def with_shared_openings(turns: DataFrame, group: int = 20, most: int = 4) -> DataFrame:
    """Each conversation with the first turns of the first of its group in place of its own.

    Conversation ``c`` takes ``crc32(c) % most`` turns of ``c - c % group``; the remainder has the sign of
    ``c``, as in SQL.
    """
    first = turns.filter(F.col("conv_id") % group == 0).select(
        F.col("conv_id").alias("base"), F.slice("turns", 1, most - 1).alias("opening")
    )
    taken = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int")
    joined = turns.join(first, F.col("conv_id") - F.col("conv_id") % group == F.col("base"), "left")
    opening = F.slice(F.coalesce("opening", F.slice("turns", 1, 0)), F.lit(1), taken)
    own = F.slice("turns", taken + 1, F.size("turns"))
    return joined.select("conv_id", F.concat(opening, own).alias("turns"))


def _next(prefix: bytes, key: bytes) -> bytes:
    return hashlib.sha256(prefix + key).digest()


def _along(keys: list[bytes]) -> list[bytes]:
    """The hash of every prefix, the root's first."""
    out = [ROOT]
    for key in keys:
        out.append(_next(out[-1], key))
    return out


def _rows(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[] for _ in schema]
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _arrow(schema: str) -> pa.Schema:
    kinds = {
        "binary": pa.binary(),
        "long": pa.int64(),
        "int": pa.int32(),
        "boolean": pa.bool_(),
        "array<binary>": pa.list_(pa.binary()),
        "array<long>": pa.list_(pa.int64()),
    }
    return pa.schema([(n, kinds[k]) for n, k in (c.split() for c in schema.split(", "))])


def _emitted(rows: Iterator[tuple], schema: str) -> Iterator[pa.RecordBatch]:
    kinds, held = _arrow(schema), []
    for row in rows:
        held.append(row)
        if len(held) == _ARROW_ROWS:
            yield _rows(held, kinds)
            held = []
    if held:
        yield _rows(held, kinds)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """Rows of batches as tuples, in small steps."""
    for batch in batches:
        for start in range(0, batch.num_rows, 256):
            part = batch.slice(start, 256)
            yield from zip(*(c.to_pylist() for c in part.columns))


def _paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = ((conv, _along(keys)[-1], keys, words) for conv, keys, words in _read(batches))
    return _emitted(rows, _PATHS)


def _prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = ((seq, p) for seq, keys in _read(batches) for p in _along(keys)[1:])
    return _emitted(rows, _PREFIXES)


def sequences(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The distinct sequences with weight and smallest conversation, and the conversations' sequences."""
    lists = turns.select(
        "conv_id", F.transform("turns", lambda t: t["key"]).alias("keys"), F.transform("turns", lambda t: t["words"]).alias("words")
    )
    paths = written(lists.mapInArrow(_paths, _PATHS), "trie-paths")
    distinct = paths.groupBy("seq").agg(
        F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("first"), F.first("keys").alias("keys"), F.first("words").alias("words")
    )
    return written(distinct, "trie-sequences"), paths.select("conv_id", "seq")


def with_heads(distinct: DataFrame, shard: int = SHARD) -> DataFrame:
    """Each sequence with the number of its prefixes, the root left out, that too many sequences share."""
    prefixes = distinct.select("seq", "keys").mapInArrow(_prefixes, _PREFIXES)
    heavy = written(prefixes.groupBy("prefix").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > shard), "trie-heads")
    if heavy.isEmpty():
        return distinct.withColumn("heads", F.lit(0))
    under = prefixes.join(broadcast_if_small(heavy.select("prefix")), "prefix", "left_semi")
    depth = under.groupBy("seq").agg(F.count(F.lit(1)).cast("int").alias("heads"))
    joined = distinct.join(depth, "seq", "left")
    return written(joined.withColumn("heads", F.coalesce("heads", F.lit(0))).select(*_names(_SEQUENCES)), "trie-dealt")


def _names(schema: str) -> list[str]:
    return [c.split()[0] for c in schema.split(", ")]


def _openings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The opening by which a sequence is dealt, before the sequence."""
    schema = "opening binary, " + _SEQUENCES
    rows = ((_along(row[3][: row[5] + 1])[-1], *row) for row in _read(batches))
    return _emitted(rows, schema)


class Shard:
    """Sequences that share their first ``top`` turns, indexed by bitsets over them."""

    def __init__(self, members: list[tuple], top: int):
        #: Ordered by their smallest conversation, so the lowest bit of a set is its smallest member.
        self.members = sorted(members, key=lambda m: m[2])
        self.top = top
        self.everyone = (1 << len(members)) - 1
        self.postings: dict[tuple[int, bytes], int] = {}
        self.going_on: dict[int, int] = {}
        self.digits: dict[int, int] = {}
        for i, (_, n, _, keys, _) in enumerate(self.members):
            bit = 1 << i
            for at in range(top, len(keys)):
                self.postings[at, keys[at]] = self.postings.get((at, keys[at]), 0) | bit
                self.going_on[at] = self.going_on.get(at, 0) | bit
            for d in range(n.bit_length()):
                if n >> d & 1:
                    self.digits[d] = self.digits.get(d, 0) | bit

    def weight(self, members: int) -> int:
        return sum((members & digit).bit_count() << d for d, digit in self.digits.items())

    def children(self, members: int, depth: int) -> Iterator[int]:
        left = members & self.going_on.get(depth, 0)
        while left:
            lowest = (left & -left).bit_length() - 1
            child = members & self.postings[depth, self.members[lowest][3][depth]]
            yield child
            left &= ~child

    def nodes(self) -> list[list]:
        """Rows of ``_NODES`` in preorder; sums over subtrees are added from the last row back."""
        path = _along(self.members[0][3][: self.top])
        out, parents = [], []
        stack = [(self.everyone, self.top, -1, path[-1])]
        while stack:
            members, depth, parent, name = stack.pop()
            seq, _, first, keys, words = self.members[(members & -members).bit_length() - 1]
            n = self.weight(members)
            below = list(self.children(members, depth))
            ended = members & ~self.going_on.get(depth, 0) != 0
            over = path[-2] if parent < 0 else out[parent][0]
            of = out[parent][2] if parent >= 0 else None
            saved = (n - 1) * words[depth - 1]
            here = len(out)
            out.append([name, over, first, depth, of, n, len(below), 0 if below else 1, saved, ended])
            parents.append(parent)
            for child in reversed(below):
                key = self.members[(child & -child).bit_length() - 1][3][depth]
                stack.append((child, depth + 1, here, _next(name, key)))
        for i in range(len(out) - 1, 0, -1):
            above = out[parents[i]]
            above[7] += out[i][7]
            above[8] += out[i][8]
        return out


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Nodes of the shards of a partition, whose rows are sorted by opening; one shard is in memory."""

    def rows():
        now, members, top = None, [], 0
        for opening, *row in _read(batches):
            if opening != now and members:
                yield from Shard(members, top).nodes()
                members = []
            now, top = opening, row[5] + 1
            members.append(tuple(row[:5]))
        if members:
            yield from Shard(members, top).nodes()

    return _emitted(map(tuple, rows()), _NODES)


def _shares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What a shard, or a sequence that ends above the shards, adds to each node above them.

    A node above has saved, besides what the shards have, its weight times its words; its own words
    are taken off once, later.
    """

    def rows():
        for top, ended, n, conv, leaves, saved, keys, words in _read(batches):
            depth = len(keys) if ended else top - 1
            below = saved or 0
            path = _along(keys[:depth])
            for at in range(depth, -1, -1):
                own = words[at - 1] if at else 0
                below += n * own
                yield path[at], at, own, n, conv, leaves or 0, below, int(not ended and at == depth)

    return _emitted(rows(), _SHARES)


def _own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each head node: its own words to itself and all above, and itself as a child."""

    def rows():
        for node, depth, last_words, keys in _read(batches):
            path = _along(keys[:depth])
            for at in range(depth + 1):
                yield path[at], last_words, int(at == depth - 1), node, path[depth - 1] if depth else None

    return _emitted(rows(), _OWN)


def _heads(dealt: DataFrame, tops: DataFrame) -> DataFrame:
    """The nodes above the shards."""
    ends_above = dealt.filter(F.size("keys") <= F.col("heads")).select(
        F.lit(0).cast("long").alias("top"),
        F.lit(True).alias("ended"),
        "n",
        F.col("first").alias("conv_id"),
        F.lit(0).cast("long").alias("leaves"),
        F.lit(0).cast("long").alias("saved"),
        "keys",
        "words",
    )
    members = dealt.select("first", "keys", "words")
    of_shards = tops.join(members, F.col("conv_id") == F.col("first")).select(
        F.col("depth").alias("top"),
        F.lit(False).alias("ended"),
        F.col("n_convs").alias("n"),
        "conv_id",
        F.col("n_leaves").alias("leaves"),
        F.col("saved_tokens").alias("saved"),
        "keys",
        "words",
    )
    shares = ends_above.unionByName(of_shards).mapInArrow(_shares, _SHARES)
    added = written(
        shares.groupBy("node").agg(
            F.min("depth").alias("depth"),
            F.min("last_words").alias("last_words"),
            F.sum("n").alias("n_convs"),
            F.min("conv_id").alias("conv_id"),
            F.sum("leaves").alias("n_leaves"),
            F.sum("saved").alias("saved"),
            F.sum("children").alias("children"),
        ),
        "trie-heads-added",
    )
    smallest = broadcast_if_small(added.select("node", "depth", "last_words", "conv_id"))
    named = smallest.join(members, F.col("conv_id") == F.col("first")).select("node", "depth", "last_words", "keys")
    own = written(named.mapInArrow(_own, _OWN), "trie-heads-own")
    taken = own.groupBy("node").agg(F.sum("own").alias("own"), F.sum("children").alias("more"))
    above = own.filter("node = of").select("node", "above")
    over = added.select(F.col("node").alias("above"), F.col("conv_id").alias("parent_conv_id"))
    ended = dealt.filter(F.size("keys") <= F.col("heads")).select(F.col("seq").alias("node"), F.lit(True).alias("ended"))
    whole = added.join(taken, "node").join(above, "node").join(over, "above", "left").join(ended, "node", "left")
    n_children = F.col("children") + F.col("more")
    return whole.select(
        "node",
        "above",
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        n_children.alias("n_children"),
        F.when(n_children == 0, 1).otherwise(F.col("n_leaves")).cast("long").alias("n_leaves"),
        (F.col("saved") - F.col("own")).alias("saved_tokens"),
        F.coalesce("ended", F.lit(False)).alias("ended"),
    )


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One hash per sequence of the ids in lists sorted by sequence and range of ids."""

    def rows():
        now, digest = None, None
        for seq, _, ids in _read(batches):
            text = ",".join(map(str, ids))
            if seq != now:
                if now is not None:
                    yield now, digest.hexdigest()
                now, digest = seq, hashlib.sha256(text.encode())
            else:
                digest.update(f",{text}".encode())
        if now is not None:
            yield now, digest.hexdigest()

    kinds = pa.schema([("seq", pa.binary()), ("ends_sha256", pa.string())])
    for row in rows():
        yield _rows([row], kinds)


def ends(conv_sequences: DataFrame) -> DataFrame:
    """``seq, ends_sha256``: the hash of the ids of all conversations of a sequence, ascending."""
    chunk = F.floor(F.col("conv_id") / F.lit(CHUNK)).alias("chunk")
    lists = conv_sequences.groupBy("seq", chunk).agg(F.sort_array(F.collect_list("conv_id")).alias("ids"))
    dealt = lists.repartition("seq").sortWithinPartitions("seq", "chunk").select("seq", "chunk", "ids")
    return dealt.mapInArrow(_hashed, "seq binary, ends_sha256 string")


def trie(spark: SparkSession, turns: DataFrame, shard: int = SHARD) -> DataFrame:
    """All nodes of ``turn_lists``: ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256, node``; ``node`` is a hash of the turns that lead to it."""
    distinct, conv_sequences = sequences(turns)
    dealt = with_heads(distinct, shard)
    count = distinct.count()
    sharded = dealt.filter(F.size("keys") > F.col("heads")).select(*_names(_SEQUENCES))
    opened = sharded.mapInArrow(_openings, "opening binary, " + _SEQUENCES)
    rows = opened.repartition(count // TASK_SEQUENCES + 1, "opening").sortWithinPartitions("opening")
    below = written(rows.mapInArrow(_shards, _NODES), "trie-nodes")
    tops = below.filter("parent_conv_id is null")
    heads = written(_heads(dealt, tops), "trie-heads-whole")
    over = broadcast_if_small(heads.select(F.col("node").alias("above"), F.col("conv_id").alias("over")))
    named = tops.join(over, "above").withColumn("parent_conv_id", F.col("over")).drop("over")
    nodes = below.filter("parent_conv_id is not null").unionByName(named).unionByName(heads)
    columns = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    with_ends = nodes.filter("ended").join(ends(conv_sequences).withColumnRenamed("seq", "node"), "node")
    without = nodes.filter("not ended").withColumn("ends_sha256", F.lit(_EMPTY))
    return with_ends.unionByName(without).select(*columns, "ends_sha256", "node")
