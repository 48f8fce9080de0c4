"""A Jaccard self-join of documents' word shingles, returned as components.

One pass cuts texts into chunks, sends each chunk's distinct shingles to parts by ranges of their hash, counts there how
many documents hold each, and returns to the chunk those that more than one holds. A document's shingles are then
ordered rare first by their exact document frequency. Two sets that reach the threshold share a shingle among the first
|x| - ceil(t |x|) + 1 of each, and shingles held once are first and shared with nobody: a set whose prefix has no others
links with nothing and ends here, so most texts are gone after one pass. Of the rest the shared shingles, its core, are
kept; they decide every overlap. Sets with equal cores and sizes link alike and go on as one node.

The prefixes of nodes are joined by shingle. Pairs are not made all against all within a shingle's list. In a round a
list's pivots are paired with the nodes that aren't yet in their component and that pass the length, positional and
suffix filters; each pair is verified once by its cores. Then components are worked out anew, lists that lie in one
component are closed, and pivots, being compared with their whole list, leave it. Once the comparisons left in all open
lists are few, they are all made. No link is lost: a pair in one list is either compared, ruled out by a filter, or
already in one component.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hivelens.llm.common import frugal, ship_package, stage_table, texts_of, total_bytes, whole_text
from hivelens.llm.scan import Words, mix, shingles

#: Text of a chunk, and of all chunks for each part of the shingles.
CHUNK_BYTES, PART_BYTES = 2 << 20, 8 << 20
#: Comparisons in open lists, as a multiple of all lists' rows, up to which all are made at once.
FEW_PAIRS = 256
#: Nodes of a list that are compared with the whole list in a round after the first; the first has one.
PIVOTS = 16
#: A list is dealt over tasks in pieces of so many nodes.
PIECE_NODES = 1024
#: Links up to which one task (not the driver) works out components; with more, rounds over tables do.
LOCAL_LINKS = 1_000_000
#: 64-bit words of the parities that the suffix filter compares.
PARITIES = 8
_MANY = 0xFFFF


def _chunks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[list, list[bytes]]]:
    ids, texts, n = [], [], 0
    for batch in batches:
        for i, t in zip(batch.column("doc_id").to_pylist(), texts_of(batch)):
            if texts and (n + len(t) > size or len(texts) == _MANY - 1):
                yield ids, texts
                ids, texts, n = [], [], 0
            ids.append(i)
            texts.append(t)
            n += len(t)
    if texts:
        yield ids, texts


def chunk_sets(texts: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """(shingle, text) of all texts, each once, ordered by shingle."""
    words = Words(texts)
    m = max(0, len(words.hash) - width + 1)
    roll = np.zeros(m, dtype=np.uint64)
    for k in range(width):
        roll = roll * np.uint64(0x2545F4914F6CDD1D) + words.hash[k : k + m]
    inside = words.doc[:m] == words.doc[width - 1 :]
    short = np.flatnonzero((words.count > 0) & (words.count < width))
    token = np.concatenate([mix(roll[inside] + np.uint64(width)), *(shingles(words.hash[words.first[i] : words.first[i + 1]], width) for i in short)])
    doc = np.concatenate([words.doc[:m][inside], short])
    order = np.argsort(token, kind="stable")
    token, doc = token[order], doc[order]
    new = np.ones(len(token), dtype=bool)
    new[1:] = (token[1:] != token[:-1]) | (doc[1:] != doc[:-1])
    return token[new], doc[new]


def set_keys(token: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    """A 128-bit key of each text's set, the same for equal sets."""
    out = np.zeros((n, 2), dtype=np.uint64)
    order = np.argsort(doc.astype(np.uint16) if n <= _MANY else doc, kind="stable")
    first = np.flatnonzero(np.diff(doc[order], prepend=-1))
    if len(first):
        token, at = token[order], doc[order][first]
        size = np.diff(np.append(first, len(token))).astype(np.uint64)
        for j, (a, b) in enumerate(((0x632BE59BD9B4E019, 0x9E3779B97F4A7C15), (0xD1B54A32D192ED03, 0xBF58476D1CE4E5B9))):
            out[at, j] = mix(np.add.reduceat(mix(token * np.uint64(b) + np.uint64(a)), first) + size)
    return out


def _pack(*arrays: np.ndarray) -> bytes:
    """Arrays as byte planes under zstandard; the first is ascending and stored by its differences."""
    planes = []
    for k, a in enumerate(arrays):
        raw = np.ascontiguousarray(np.diff(a, prepend=a.dtype.type(0)) if k == 0 else a)
        planes.append((raw.dtype.str, raw.view(np.uint8).reshape(len(raw), raw.itemsize).T.tobytes()))
    return zstandard.ZstdCompressor(level=1).compress(pickle.dumps(planes))


def _unpack(data: bytes) -> list[np.ndarray]:
    out = []
    for k, (kind, raw) in enumerate(pickle.loads(zstandard.ZstdDecompressor().decompress(data))):
        size = np.dtype(kind).itemsize
        a = np.ascontiguousarray(np.frombuffer(raw, dtype=np.uint8).reshape(size, -1).T).reshape(-1).view(kind)
        out.append(np.cumsum(a, dtype=a.dtype) if k == 0 else a)
    return out


def _prefix_size(n: np.ndarray, percent: int) -> np.ndarray:
    return n - (percent * n + 99) // 100 + 1


def survey(docs: DataFrame, width: int, percent: int, part_bytes: int = PART_BYTES, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """A row for each document: doc_id, n (size of its set), node (128-bit key of its set; missing for an empty one).

    Rows whose prefix has a shingle of another document also have core (their shingles that others hold, as 64-bit
    numbers, rare first), k (how many) and parities s0, s1, ... of the core; of rows with equal sets in one chunk the
    first has these. Rows without doc_id have none. A shingle of a third of all documents costs a part one entry for
    each chunk, not for each document.
    """
    size = total_bytes(docs)
    parts, chunks = max(16, math.ceil(size / part_bytes)), max(16, math.ceil(size / (4 * chunk_bytes)))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        bounds = np.array([(p << 64) // parts for p in range(1, parts)], dtype=np.uint64)
        for number, (ids, texts) in enumerate(_chunks(batches, chunk_bytes)):
            chunk = task << 32 | number
            token, doc = chunk_sets(texts, width)
            size, key = np.bincount(doc, minlength=len(texts)), set_keys(token, doc, len(texts))
            speaks = np.zeros(len(texts), dtype=bool)
            has_id = np.array([i is not None for i in ids])
            use = np.flatnonzero(has_id & (size > 0))
            if len(use):
                speaks[use[np.unique(key[use], axis=0, return_index=True)[1]]] = True
            own = speaks[doc]
            token, doc = token[own], doc[own]
            first = np.flatnonzero(np.concatenate(([True], token[1:] != token[:-1]))) if len(token) else np.zeros(0, dtype=np.int64)
            count = np.diff(np.append(first, len(token)))
            owner = np.where(count > 1, _MANY, doc[first]).astype("<u2")
            many = np.repeat(count > 1, count)
            table = (ids, size, key, speaks, _pack(token[many], doc[many].astype("<u2")))
            kinds, edges = token[first], np.concatenate(([0], np.searchsorted(token[first], bounds), [len(first)]))
            sent = [(chunk % parts, True, pickle.dumps(table))]
            for p in range(parts):
                a, b = edges[p], edges[p + 1]
                if a < b:
                    c = count[a:b]
                    sent.append((p, False, pickle.dumps((_pack(kinds[a:b], owner[a:b]), c[c > 1].astype("<u2")))))
            p, whole, data = zip(*sent)
            yield pa.RecordBatch.from_arrays([pa.array([chunk] * len(p), pa.int64()), pa.array(p, pa.int32()), pa.array(whole, pa.bool_()), pa.array(data, pa.binary())], ["chunk", "part", "table", "data"])

    def count(t: pa.Table) -> pa.Table:
        whole = t["table"].to_numpy()
        chunks, data = t["chunk"].to_numpy(), t["data"]
        out = [(int(chunks[i]), True, data[int(i)].as_py()) for i in np.flatnonzero(whole)]
        counted = np.flatnonzero(~whole.astype(bool))
        tokens, owners, counts = [], [], []
        for i in counted:
            packed, more = pickle.loads(data[int(i)].as_py())
            token, owner = _unpack(packed)
            c = np.ones(len(token), dtype=np.int64)
            c[owner == _MANY] = more
            tokens.append(token)
            owners.append(owner)
            counts.append(c)
        if tokens:
            every = np.concatenate(tokens)
            order = np.argsort(every, kind="stable")
            ordered = every[order]
            first = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))
            total = np.add.reduceat(np.concatenate(counts)[order], first)
            df = np.empty(len(every), dtype=np.int64)
            df[order] = np.repeat(total, np.diff(np.append(first, len(every))))
            a = 0
            for i, token, owner in zip(counted, tokens, owners):
                mine = df[a : a + len(token)]
                a += len(token)
                shared = mine > 1
                if shared.any():
                    out.append((int(chunks[i]), False, _pack(token[shared], owner[shared], np.minimum(mine[shared], 0xFFFFFFFF).astype("<u4"))))
        a, b, c = zip(*out) if out else ((), (), ())
        return pa.table({"chunk": pa.array(a, pa.int64()), "table": pa.array(b, pa.bool_()), "data": pa.array(c, pa.binary())})

    def gather(t: pa.Table) -> pa.Table:
        whole, data = t["table"].to_numpy().astype(bool), t["data"]
        ids, size, key, speaks, packed = pickle.loads(data[int(np.flatnonzero(whole)[0])].as_py())
        parts_ = [_unpack(data[int(i)].as_py()) for i in np.flatnonzero(~whole)]
        token, owner, df = (np.concatenate([p[j] for p in parts_]) if parts_ else np.zeros(0, dtype=d) for j, d in enumerate(("<u8", "<u2", "<u4")))
        many_token, many_doc = _unpack(packed)
        held_by_many = owner == _MANY
        kinds, frequency = token[held_by_many], df[held_by_many]
        order = np.argsort(kinds)
        many_df = frequency[order][np.searchsorted(kinds[order], many_token)] if len(kinds) else np.zeros(0, dtype="<u4")
        token, doc = np.concatenate([token[~held_by_many], many_token]), np.concatenate([owner[~held_by_many], many_doc])
        df = np.concatenate([df[~held_by_many], many_df])
        k = np.bincount(doc, minlength=len(ids))
        alive = speaks & (_prefix_size(size, percent) > size - k)
        own = alive[doc]
        token, doc, df = token[own], doc[own], df[own]
        order = np.lexsort((token, df, doc))
        token, doc = token[order], doc[order]
        first = np.flatnonzero(np.diff(doc.astype(np.int64), prepend=-1))
        at, last = doc[first], np.append(first[1:], len(doc))
        core: list[bytes | None] = [None] * len(ids)
        for i, a, b in zip(at, first, last):
            core[i] = token[a:b].tobytes()
        hashed = mix(token + np.uint64(0xA0761D6478BD642F))
        bit = np.uint64(1) << (hashed & np.uint64(63))
        word = (hashed >> np.uint64(6)) % np.uint64(PARITIES)
        keys = np.zeros((len(ids), 2), dtype=np.uint64)
        columns = {}
        if len(first):
            keys[at] = set_keys(token, doc.astype(np.int64), len(ids))[at]
        for j in range(PARITIES):
            values = np.zeros(len(ids), dtype=np.uint64)
            if len(first):
                values[at] = np.bitwise_xor.reduceat(np.where(word == j, bit, np.uint64(0)), first)
            columns[f"s{j}"] = values.view(np.int64)
        as_keys = lambda rows, use: pa.array([r.tobytes() if u else None for r, u in zip(rows, use)], pa.binary())
        return pa.table({"doc_id": pa.array(ids, pa.int64()), "n": size.astype(np.int64), "node": as_keys(key, size > 0), "core": pa.array(core, pa.binary()), "core_key": as_keys(keys, alive), "k": k.astype(np.int64)} | columns)

    sent = docs.mapInArrow(frugal(send), "chunk long, part int, table boolean, data binary")
    counted = sent.repartition(parts, "part").groupBy("part").applyInArrow(frugal(count), "chunk long, table boolean, data binary")
    parities = ", ".join(f"s{j} long" for j in range(PARITIES))
    return counted.repartition(chunks, "chunk").groupBy("chunk").applyInArrow(frugal(gather), f"doc_id long, n long, node binary, core binary, core_key binary, k long, {parities}")


def similar_components(docs: DataFrame, width: int = 5, percent: int = 75, few_pairs: int = FEW_PAIRS, local_links: int = LOCAL_LINKS, part_bytes: int = PART_BYTES, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """doc_id, n_shingles and component_id of each row: the smallest doc_id reachable by links.

    Two documents link when 100 * |intersection| >= percent * |union| of their sets of `width`-word shingles; a text with
    fewer words is one shingle, and one without words (or missing) is empty and links with nothing. Rows with equal ids
    and texts count as one document; rows with a missing id get a missing component and take part in no link. Other
    columns are ignored; an empty table stays empty. Shingles are compared by 64-bit hashes, sets by 128-bit ones.
    """
    spark = docs.sparkSession
    ship_package(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    seen = stage_table(survey(rows, width, percent, part_bytes, chunk_bytes), "survey")
    known = seen.select("doc_id", "n", "node")
    filled = known.where("node is not null and doc_id is not null")
    signs = [f"s{j}" for j in range(PARITIES)]
    alive = seen.where("core is not null").dropDuplicates(["node"])

    # Sets with one core overlap in all of it, so their sizes decide: those that link with the smallest of them link with
    # nothing that it doesn't link with, and others of one size link alike, though not with each other.
    sizes = stage_table(alive.select("node", "n", "k", "core_key"), "sizes")
    least = sizes.groupBy("core_key").agg(F.min("n").alias("m"))
    solid = lambda n: 100 * F.col("k") >= percent * (F.col(n) + F.col("m") - F.col("k"))
    placed = sizes.join(least, "core_key").select("node", "n", "core_key", F.when(solid("n"), F.col("m")).otherwise(F.col("n")).alias("size"), solid("n").alias("solid"))
    stands = placed.groupBy("core_key", "size").agg(F.min(F.struct("n", "node"))["node"].alias("rep"))
    belongs = stage_table(placed.join(stands, ["core_key", "size"]).select("node", "rep", "solid"), "belongs")
    nodes = stage_table(alive.join(belongs.where("node = rep").select("node"), "node", "left_semi").select("node", "n", "k", "core", *signs), "nodes")

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tokens, names, places = [np.zeros(0, dtype=np.int64)], [], [np.zeros(0, dtype=np.int64)]
            for node, n, k, core in zip(*(batch.column(c).to_pylist() for c in ("node", "n", "k", "core"))):
                size = min(k, n - (percent * n + 99) // 100 + 1 - (n - k))
                tokens.append(np.frombuffer(core, dtype="<i8")[:size])
                places.append(np.arange(n - k, n - k + size))
                names += [node] * size
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(tokens)), pa.array(names, pa.binary()), pa.array(np.concatenate(places)).cast(pa.int32())], ["token", "node", "pos"])

    prefix = stage_table(nodes.select("node", "n", "k", "core").mapInArrow(frugal(prefixes), "token long, node binary, pos int"), "prefixes")
    # Lists of the same nodes say the same: the first of their shingles stands for them.
    lists = prefix.groupBy("token").agg(F.count("*").alias("c"), F.min(F.struct("node", "pos")).alias("a"), F.max("node").alias("b"), F.sum(F.xxhash64("node").cast("decimal(20,0)")).alias("key"))
    lists = lists.where("c > 1").groupBy("a.node", "b", "key", "c").agg(F.min(F.struct("a.pos", "token")).alias("t")).select("t.token")
    traits = nodes.select("node", "n", "k", *signs)
    open_ = stage_table(prefix.join(lists, "token").join(traits, "node"), "lists")
    enough = few_pairs * open_.count()

    def possible() -> Column:
        """Length, positional and suffix filter: an overlap that suffices fits into the sizes, into what follows the first
        shared shingle of both, and leaves no more shingles in one core only than the parities of both cores say."""
        least = F.floor((percent * (F.col("n") + F.col("p_n")) + 99 + percent) / (100 + percent))
        odd = sum((F.bit_count(F.col(s).bitwiseXOR(F.col(f"p_{s}"))) for s in signs[1:]), F.bit_count(F.col("s0").bitwiseXOR(F.col("p_s0"))))
        fits = (least <= F.least("k", "p_k")) & (F.col("pos") <= F.col("n") - least) & (F.col("p_pos") <= F.col("p_n") - least)
        return fits & (odd <= F.col("k") + F.col("p_k") - 2 * least)

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for n, m, a, b in zip(*(batch.column(c).to_pylist() for c in ("x_n", "y_n", "x_core", "y_core"))):
                s, t = np.sort(np.frombuffer(a, dtype="<u8")), np.sort(np.frombuffer(b, dtype="<u8"))
                far = len(s) + len(t) - 2 * -(-percent * (n + m) // (100 + percent))
                if suffix_distance(s, t, far) > far:
                    linked.append(False)
                    continue
                both = len(np.intersect1d(s, t, assume_unique=True))
                linked.append(100 * both >= percent * (n + m - both))
            yield pa.RecordBatch.from_arrays([batch.column("x"), batch.column("y"), pa.array(linked, pa.bool_())], ["x", "y", "linked"])

    components: DataFrame | None = None
    links: DataFrame | None = None
    compared: DataFrame | None = None
    while True:
        if components is None:
            here = open_.withColumn("comp", F.col("node"))
        else:
            here = open_.join(components, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
        per = here.groupBy("token", "comp").agg(F.count("*").alias("c"))
        per = per.groupBy("token").agg(F.sum("c").alias("rows"), F.count("*").alias("comps"), F.max(F.struct("c", "comp")).alias("most")).where("comps > 1")
        per = stage_table(per.select("token", F.col("most.comp").alias("largest"), F.expr("rows * (rows - most.c)").alias("pairs"), F.ceil(F.col("rows") / PIECE_NODES).cast("int").alias("pieces")), "state")
        left = per.agg(F.count("*").alias("lists"), F.sum("pairs").alias("pairs")).first()
        if not left["lists"]:
            break
        here = here.join(per, "token")
        final = compared is not None and left["pairs"] <= enough
        if final:  # of two nodes in different components, one isn't in the list's largest
            pivots = here.where("comp <> largest")
        else:
            here = stage_table(here, "open")
            # The node with the fewest shingles of its own is the likeliest to link with others.
            rank = F.row_number().over(Window.partitionBy("token").orderBy(F.col("n") - F.col("k"), "node"))
            pivots = here.withColumn("rank", rank).where(F.col("rank") <= (1 if compared is None else PIVOTS))
        names = ("node", "n", "k", "pos", "comp", *signs)
        pivots = pivots.select("token", *[F.col(c).alias(f"p_{c}") for c in names], F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("piece"))
        dealt = here.withColumn("piece", F.pmod(F.xxhash64("node"), F.col("pieces")).cast("int"))
        pairs = dealt.join(pivots, ["token", "piece"]).where((F.col("p_node") != F.col("node")) & (F.col("p_comp") != F.col("comp")) & possible())
        pairs = pairs.groupBy(F.least("p_node", "node").alias("x"), F.greatest("p_node", "node").alias("y")).agg(F.lit(1).alias("one")).drop("one")
        if compared is not None:
            pairs = pairs.join(compared, ["x", "y"], "left_anti")
        side = lambda s: nodes.select(F.col("node").alias(s), F.col("n").alias(f"{s}_n"), F.col("core").alias(f"{s}_core"))
        verdict = stage_table(pairs.join(side("y"), "y").join(side("x"), "x").mapInArrow(frugal(verify), "x binary, y binary, linked boolean"), "verdicts")
        compared = verdict.select("x", "y") if compared is None else compared.unionByName(verdict.select("x", "y"))
        new = verdict.where("linked").select("x", "y")
        links = new if links is None else links.unionByName(new)
        components = connected(links, local_links)
        if final:
            break
        used = pivots.select("token", F.col("p_node").alias("node")).distinct()
        open_ = stage_table(here.join(used, ["token", "node"], "left_anti").select(*open_.columns), "open")

    # The first id of each set, of each node's sets and of each component; sums per key are pre-aggregated.
    holders = stage_table(filled.groupBy("node").agg(F.min("doc_id").alias("doc_id")), "holders")
    groups = holders.join(belongs, "node")
    if components is not None:
        groups = groups.join(components.withColumnRenamed("node", "rep"), "rep", "left")
    else:
        groups = groups.withColumn("comp", F.lit(None).cast("binary"))
    groups = groups.select("node", "doc_id", F.when(F.col("comp").isNotNull(), F.col("comp")).when(F.col("solid"), F.col("rep")).otherwise(F.col("node")).alias("comp"))
    groups = stage_table(groups, "groups")
    firsts = groups.groupBy("comp").agg(F.min("doc_id").alias("component_id"))
    moved = groups.join(firsts, "comp").where("component_id <> doc_id").select("node", F.col("component_id").alias("moved_to"))
    labels = holders.join(moved, "node", "left").select("node", F.coalesce("moved_to", "doc_id").alias("component_id"))
    out = known.join(labels, "node", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("node").isNotNull() & F.col("doc_id").isNotNull(), F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def suffix_distance(a: np.ndarray, b: np.ndarray, most: int, depth: int = 3) -> int:
    """A lower bound of the number of elements in one of two ordered sets only, by halving both at the same element."""
    if depth == 0 or not len(a) or not len(b) or abs(len(a) - len(b)) > most:
        return abs(len(a) - len(b))
    middle = b[len(b) // 2]
    i, j = int(np.searchsorted(a, middle)), int(np.searchsorted(b, middle))
    left = suffix_distance(a[:i], b[:j], most - abs(len(a) - i - len(b) + j), depth - 1)
    return left + suffix_distance(a[i:], b[j:], most - left, depth - 1)


def connected(links: DataFrame, local_links: int = LOCAL_LINKS) -> DataFrame:
    """(node, comp) of all nodes with a link (x, y): comp is the smallest node of the component. Links may repeat and loop.

    Up to local_links links go to one task. With more, every node goes to the smallest of itself and its neighbours
    in each turn and links are carried over, until none is left between different nodes. Sums per node are
    pre-aggregated, so a node may have any number of links. No links give no rows.
    """
    links = links.where("x <> y").select("x", "y")
    if links.count() <= local_links:
        kind = dict(links.dtypes)["x"]

        def union(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            parent: dict = {}

            def root(a):
                parent.setdefault(a, a)
                while parent[a] != a:
                    parent[a] = parent[parent[a]]
                    a = parent[a]
                return a

            for batch in batches:
                for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist()):
                    a, b = root(x), root(y)
                    if a != b:
                        parent[max(a, b)] = min(a, b)
            names = list(parent)
            type_ = pa.binary() if kind == "binary" else pa.int64()
            for i in range(0, len(names), 65_536):
                some = names[i : i + 65_536]
                yield pa.RecordBatch.from_arrays([pa.array(some, type_), pa.array([root(a) for a in some], type_)], ["node", "comp"])

        return stage_table(links.coalesce(1).mapInArrow(frugal(union), f"node {kind}, comp {kind}"), "comp")
    edges = stage_table(links.distinct(), "edges")
    comp = None
    while True:
        both = edges.unionByName(edges.select(F.col("y").alias("x"), F.col("x").alias("y")))
        to = stage_table(both.groupBy(F.col("x").alias("node")).agg(F.min("y").alias("m")).select("node", F.least("node", "m").alias("to")), "to")
        comp = to.select("node", F.col("to").alias("comp")) if comp is None else comp.join(to.select(F.col("node").alias("comp"), "to"), "comp", "left").select("node", F.coalesce("to", "comp").alias("comp"))
        comp = stage_table(comp, "comp")
        a = edges.join(to.select(F.col("node").alias("x"), F.col("to").alias("tx")), "x").join(to.select(F.col("node").alias("y"), F.col("to").alias("ty")), "y")
        edges = stage_table(a.where("tx <> ty").select(F.col("tx").alias("x"), F.col("ty").alias("y")).distinct(), "edges")
        if edges.isEmpty():
            return comp
