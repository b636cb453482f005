"""N-gram Jaccard self-join by a MinHash LSH forest with exact verification (operator 3).

1. One pass makes each text's set of word shingles, a 128-bit class hash of the set (texts with equal sets are one
   class, and only one of them goes on) and its place in each of TREES prefix tries: a signature of DEPTH min-hash values.
   Of one text in PLANT_EVERY the pass also makes a partner whose similarity is the threshold, and notes in how many tries the two
   share a prefix of each length.
2. Matching starts at the full depth and shortens the prefix until the recall that these planted pairs show reaches the target. As
   they have the least similarity that counts, all other pairs are found more surely still.
3. Each task sorts its signatures tree by tree, which is a trie in reading order: signatures that share a prefix stand side by side.
   Each such run is linked to its least text and one entry goes on for it, so a prefix that very many texts share costs
   its owner a row for each task.
4. Texts linked through any prefix form a block. All pairs of a block are verified exactly by their shingle sets, as products of
   0/1 matrices over tiles of the block's parts, which emit a row for each text and never a row for each pair.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BROADCAST_IDS, buffer_of, fresh, groups_for, keyed, materialize, may_have, semi_by_key, slices, text_or_empty
from .components import components
from .wordhash import U, mix, shingles, words

SHINGLE_WORDS = 5
TREES, DEPTH = 32, 8
#: Chance, at least, that a pair exactly at the threshold becomes a candidate.
RECALL = 0.9999
#: One text in so many gets a planted partner.
PLANT_EVERY = 32
#: Comparisons of two signatures' trees that the chance of independent values counts for beside the planted pairs, so that few pairs don't decide alone.
PRIOR = 4_096
#: Texts of a block's part: the wish, parts that a block has at most for its sake, and the most texts and shingles of a part.
PART_WISH, PARTS_WISHED, PART_TEXTS, PART_SHINGLES = 128, 8, 4_096, 2_000_000
#: Texts and columns of one 0/1 matrix.
_STRIP, _COLUMNS = 512, 4_096
#: Texts of small tiles that are read together.
_SMALL = 256
#: Members of blocks whose tiles one task gets, about.
_DEALT = 50_000
#: Prefix entries of one owner, about.
_OWNED = 4_000_000


def _permutations(n: int) -> tuple[np.ndarray, np.ndarray]:
    seed = mix(np.arange(1, 2 * n + 1, dtype=U))
    return (seed[:n] >> U(32)).astype(np.uint32) | np.uint32(1), (seed[n:] >> U(32)).astype(np.uint32)


def signatures(sets: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """(texts, TREES, DEPTH) min-hash values of 16 bits; text i has the shingles sets[cuts[i]:cuts[i + 1]], one at least."""
    a, b = _permutations(TREES * DEPTH)
    short = (sets >> U(32)).astype(np.uint32)
    out = np.empty((len(cuts), TREES * DEPTH), dtype=np.uint16)
    for d in range(TREES * DEPTH):
        least = np.minimum.reduceat(short * a[d] + b[d], cuts)
        out[:, d] = ((least * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype(np.uint16)
    return out.reshape(len(cuts), TREES, DEPTH)


def planted_partner(own: np.ndarray, num: int, den: int, seed: int) -> np.ndarray | None:
    """A set whose similarity with own is num / den or just above: some shingles gone, as many strangers in. None for a set too small to tell."""
    n = len(own)
    change = (n * (den - num)) // (den + num)  # (n - c) / (n + c) >= num / den
    if not change:
        return None
    gone = np.random.default_rng(seed).permutation(n)[:change]
    strangers = mix(own[gone] ^ U(0xA5A5A5A5A5A5A5A5))
    return np.concatenate((np.delete(own, gone), strangers))


def shared_depths(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """For each depth from 1 to DEPTH, in how many trees two signatures share a prefix of that length."""
    return np.logical_and.accumulate(x == y, axis=1).sum(axis=0)


def signature_rows(docs: DataFrame, key: str, text_col: str, num: int, den: int, k: int = SHINGLE_WORDS) -> DataFrame:
    """(key, n, cls, signature, planted): shingles, class hash, TREES * DEPTH values of 2 bytes, and shared_depths with the planted partner or null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            raw, offsets = buffer_of(batch.column(1))
            rows = batch.num_rows
            _, _, row, hashes = words(raw, offsets)
            flat, at = shingles(hashes, row, rows, k)
            size = np.diff(at)
            full = np.flatnonzero(size)
            found: list[bytes | None] = [None] * rows
            planted: list[list[int] | None] = [None] * rows
            keys = np.asarray(batch.column(0))
            if len(full):
                made = signatures(flat, at[full])
                for i, r in enumerate(full.tolist()):
                    found[r] = made[i].tobytes()
                chosen = np.flatnonzero(mix(keys[full].astype(U)) % U(PLANT_EVERY) == 0)
                partners = [(i, p) for i in chosen.tolist() if (p := planted_partner(flat[at[full[i]] : at[full[i] + 1]], num, den, int(keys[full[i]]) & 0xFFFFFFFF)) is not None]
                if partners:
                    theirs = signatures(np.concatenate([p for _, p in partners]), np.concatenate(([0], np.cumsum([len(p) for _, p in partners])[:-1])))
                    for (i, _), other in zip(partners, theirs, strict=True):
                        planted[full[i]] = shared_depths(made[i], other).tolist()
            cls = [hashlib.blake2b(flat[at[i] : at[i + 1]].tobytes() if size[i] else b"empty" + int(keys[i]).to_bytes(8, "little", signed=True), digest_size=16).digest() for i in range(rows)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(size), pa.array(cls, pa.binary()), pa.array(found, pa.binary()), pa.array(planted, pa.list_(pa.int32()))], ["key", "n", "cls", "signature", "planted"]
            )

    rows = docs.select(F.col(key).alias("key"), text_or_empty(text_col).alias("text"))
    return rows.mapInArrow(run, "key long, n long, cls binary, signature binary, planted array<int>")


def measured_recall(rows: DataFrame, threshold: float) -> list[float]:
    """For each depth from 1 to DEPTH, the chance that a pair at the threshold shares a prefix of that length in some tree.

    The share of trees in which planted pairs do, with the chance of independent values as PRIOR trees more, gives the chance for one tree.
    """
    planted = rows.where("planted is not null").agg(F.count("*").alias("n"), *[F.sum(F.col("planted")[d]).alias(f"d{d}") for d in range(DEPTH)]).first()
    tried = planted.n * TREES + PRIOR
    return [1 - (1 - ((planted[f"d{d}"] or 0) + PRIOR * threshold ** (d + 1)) / tried) ** TREES for d in range(DEPTH)]


def prefix_depth(recall: list[float], target: float = RECALL) -> int:
    """Shorten the matched prefix from the full depth down until its recall reaches the target (1 if none does)."""
    depth = len(recall)
    while depth > 1 and recall[depth - 1] < target:
        depth -= 1
    return depth


def _trie_runs(sig: np.ndarray, key: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Signatures of one tree in trie order: the order, the first place of each run that shares a prefix, and the least key of each entry's run."""
    order = np.lexsort((key, *(sig[:, d] for d in reversed(range(depth)))))
    sorted_ = sig[order, :depth]
    first = np.ones(len(order), dtype=bool)
    first[1:] = (sorted_[1:] != sorted_[:-1]).any(axis=1)
    start = np.flatnonzero(first)
    return order, start, np.repeat(key[order][start], np.diff(np.append(start, len(order))))


def _prefix_hash(prefix: np.ndarray, tree: int) -> np.ndarray:
    out = np.full(len(prefix), tree + 1, dtype=U)
    for d in range(prefix.shape[1]):
        out = mix(out * U(0x9E3779B97F4A7C15) + prefix[:, d].astype(U))
    return out


def _edges(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    keep = a != b
    return np.unique(np.stack((a[keep], b[keep]), axis=1), axis=0)


def candidate_edges(reps: DataFrame, depth: int, n_reps: int) -> DataFrame:
    """(a, b): texts that share a prefix of `depth` values in some tree, each linked to the least of a run within its task and among tasks."""
    owners = groups_for(reps, n_reps * TREES, _OWNED)

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys: list[np.ndarray] = []
        sigs: list[np.ndarray] = []
        held = 0

        def flush() -> Iterator[pa.RecordBatch]:
            key, sig = np.concatenate(keys), np.concatenate(sigs)
            edges, labels, leasts = [], [], []
            for t in range(TREES):
                order, start, least = _trie_runs(sig[:, t], key, depth)
                edges.append(_edges(key[order], least))
                labels.append(_prefix_hash(sig[order[start], t, :depth], t))
                leasts.append(least[start])
            within = np.unique(np.concatenate(edges), axis=0)
            yield pa.RecordBatch.from_arrays([pa.array([-1], pa.int32()), pa.array([within.astype("<i8").tobytes()], pa.binary())], ["owner", "data"])
            label, least = np.concatenate(labels), np.concatenate(leasts)
            owner = (label % U(owners)).astype(np.int32)
            by = np.argsort(owner, kind="stable")
            cuts = np.concatenate(([0], np.flatnonzero(np.diff(owner[by])) + 1, [len(by)]))
            blobs = [np.concatenate((label[by[x:y]], least[by[x:y]].astype(U))).tobytes() for x, y in zip(cuts[:-1], cuts[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(owner[by[cuts[:-1]]]), pa.array(blobs, pa.binary())], ["owner", "data"])

        for batch in batches:
            if batch.num_rows:
                keys.append(np.asarray(batch.column(0)))
                sigs.append(np.frombuffer(b"".join(batch.column(1).to_pylist()), dtype=np.uint16).reshape(-1, TREES, DEPTH))
                held += batch.num_rows
            if held >= 50_000:
                yield from flush()
                keys, sigs, held = [], [], 0
        if held:
            yield from flush()

    def own(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        if key[0] < 0:  # edges within tasks, spread over many groups by `part`
            edges = np.concatenate([np.frombuffer(d, dtype="<i8").reshape(-1, 2) for d in pdf["data"]])
        else:
            parts = [np.frombuffer(d, dtype=U).reshape(2, -1) for d in pdf["data"]]
            label, every = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]).astype(np.int64)
            order = np.lexsort((every, label))
            start = np.flatnonzero(np.concatenate(([True], label[order][1:] != label[order][:-1])))
            edges = _edges(every[order], np.repeat(every[order][start], np.diff(np.append(start, len(order)))))
        return pd.DataFrame({"a": edges[:, 0], "b": edges[:, 1]})

    sent = reps.select("key", "signature").mapInArrow(send, "owner int, data binary")
    spread = sent.withColumn("part", F.when(F.col("owner") < 0, F.pmod(F.xxhash64("data"), F.lit(owners))).otherwise(F.lit(0)).cast("int"))
    return spread.groupBy("owner", "part").applyInPandas(own, "a long, b long")


def _links(x: list[np.ndarray], y: list[np.ndarray] | None, num: int, den: int) -> np.ndarray:
    """Boolean matrix: which sets of x and y (or x itself) have a Jaccard similarity of at least num / den, exactly."""
    every = x if y is None else x + y
    flat = np.concatenate(every)
    row = np.repeat(np.arange(len(every)), [len(s) for s in every])
    _, col, n = np.unique(flat, return_inverse=True, return_counts=True)
    shared = n > 1
    place = np.cumsum(shared) - 1
    keep = shared[col]
    row, col = row[keep], place[col[keep]]
    width = int(shared.sum())
    m = len(x)
    common = np.zeros((m, len(every) - m if y is not None else m), dtype=np.float32)
    order = np.argsort(col, kind="stable")
    row, col = row[order], col[order]
    for c in range(0, width, _COLUMNS):
        lo, hi = np.searchsorted(col, (c, c + _COLUMNS))
        block = np.zeros((len(every), min(_COLUMNS, width - c)), dtype=np.float32)
        block[row[lo:hi], col[lo:hi] - c] = 1
        common += block[:m] @ (block[m:] if y is not None else block).T
    size = np.array([len(s) for s in every], dtype=np.int64)
    total = size[:m, None] + (size[m:] if y is not None else size)[None, :]
    # common / (total - common) >= num / den
    return common.astype(np.int64) * (num + den) >= num * total


def _roots(links: list[tuple[np.ndarray, np.ndarray]], n: int) -> np.ndarray:
    """The least place that each of n is connected to by the links (places a, places b)."""
    label = np.arange(n)
    if not links:
        return label
    a, b = np.concatenate([x for x, _ in links]), np.concatenate([y for _, y in links])
    while True:
        new = label.copy()
        np.minimum.at(new, a, label[b])
        np.minimum.at(new, b, label[a])
        new = new[new]
        if np.array_equal(new, label):
            return label
        label = new


def _tile(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray | None, copies: np.ndarray, num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """Weight of the partners of each set (left with right, or left with itself), and the least place each is connected to, by strips of matrices."""
    linked, pairs = np.zeros(len(sets), dtype=np.int64), []
    for i in range(0, len(left), _STRIP):
        x = left[i : i + _STRIP]
        other = left if right is None else right
        for j in range(i if right is None else 0, len(other), _STRIP):
            y = other[j : j + _STRIP]
            own = right is None and i == j
            hit = _links([sets[p] for p in x], None if own else [sets[p] for p in y], num, den)
            if own:
                np.fill_diagonal(hit, False)
            linked[x] += hit @ copies[y]
            if not own:
                linked[y] += copies[x] @ hit
            # each row with its first partner, and each column with its first: a spanning set, as all links of a strip go through these or lie in the matrix
            a, b = np.nonzero(hit)
            root = _roots([(a, b + (0 if own else len(x)))], len(x) if own else len(x) + len(y))
            both = x if own else np.concatenate((x, y))
            moved = np.flatnonzero(root != np.arange(len(root)))
            pairs.append((both[moved], both[root[moved]]))
    return linked, _roots(pairs, len(sets))


def verify(members: DataFrame, docs: DataFrame, key: str, text_col: str, num: int, den: int, n_members: int, k: int = SHINGLE_WORDS) -> DataFrame:
    """(key, linked, root, whole): weight of verified partners and the least partner reached, for each member and tile.

    members: (key, block, copies, n). A block is cut into parts, whose number grows with its texts and shingles; each pair of parts is a tile. Whole says that
    the block had one part, so that root is final. Tiles are dealt out evenly and read one after the other, so a task holds one tile at a time.
    """
    sizes = members.groupBy("block").agg(F.count("*").alias("texts"), F.sum("n").alias("shingles"))
    wished = F.least(F.lit(PARTS_WISHED), F.ceil(F.col("texts") / PART_WISH))
    parts = F.greatest(wished, F.ceil(F.col("texts") / PART_TEXTS), F.ceil(F.col("shingles") / PART_SHINGLES)).cast("int")
    placed = members.join(sizes.select("block", parts.alias("parts")), "block").withColumn("own", F.pmod(F.xxhash64("key"), F.col("parts").cast("long")).cast("int"))
    text = docs.select(F.col(key).alias("key"), text_or_empty(text_col).alias("text"))
    if n_members <= BROADCAST_IDS // 4:
        full = text.join(F.broadcast(placed.drop("n")), "key")
    else:  # texts of no block are told apart by a filter and not shuffled
        full = may_have(text, "key", members, "key", n_members).where("__may").drop("__may").join(placed.drop("n"), "key")
    dealt = full.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(
        "block", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"), "key", "copies", "own", "parts", "text"
    )
    # neighbouring tiles of a block go to neighbouring partitions, so no two of a large block's meet by chance
    groups = groups_for(docs, n_members, _DEALT)
    place = F.pmod(F.pmod(F.xxhash64("block"), F.lit(groups)) + F.col("a") * F.col("parts") + F.col("b"), F.lit(groups)).cast("int")
    tiles = dealt.repartitionById(groups, place).sortWithinPartitions("block", "a", "b", "key")

    def cuts_of(batch: pa.RecordBatch | pa.Table) -> np.ndarray:
        ident = np.stack([np.asarray(batch.column(i)).astype(np.int64) for i in range(3)], axis=1)
        return np.concatenate(([0], np.flatnonzero((ident[1:] != ident[:-1]).any(axis=1)) + 1, [len(ident)]))

    def judged(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(held)
        a, b, keys, copies, own, parts_ = (np.asarray(table[c]) for c in ("a", "b", "key", "copies", "own", "parts"))
        sets: list[np.ndarray] = []
        for piece in slices(iter(table.select(["text"]).to_batches()), "text"):
            raw, offsets = buffer_of(piece.column(0))
            _, _, row, hashes = words(raw, offsets)
            flat, at = shingles(hashes, row, piece.num_rows, k)
            sets += [flat[at[i] : at[i + 1]] for i in range(piece.num_rows)]
        linked, root = np.zeros(len(keys), dtype=np.int64), keys.copy()
        cuts = cuts_of(table)
        for x, y in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            left = np.flatnonzero(own[x:y] == a[x])
            right = None if a[x] == b[x] else np.flatnonzero(own[x:y] == b[x])
            if y - x > 1 and (right is None or (len(left) and len(right))):
                linked[x:y], place = _tile(sets[x:y], left, right, copies[x:y], num, den)
                root[x:y] = keys[x:y][place]
        return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(linked), pa.array(root), pa.array(parts_ == 1)], ["key", "linked", "root", "whole"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        n, now = 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            cuts = cuts_of(batch)
            for x, y in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                tile = tuple(batch.column(i)[x].as_py() for i in range(3))
                if n >= _SMALL and tile != now:  # small tiles go together
                    yield judged(held)
                    held, n = [], 0
                now = tile
                held.append(batch.slice(x, y - x))
                n += y - x
        if held:
            yield judged(held)

    return tiles.mapInArrow(run, "key long, linked long, root long, whole boolean")


def classes(docs: DataFrame, key: str, text_col: str, num: int = 4, den: int = 5) -> DataFrame:
    """(key, class_key, rep_key, copies, n_links) for each row of docs, whose `key` is unique and not null."""
    rows = materialize(signature_rows(docs, key, text_col, num, den))
    depth = prefix_depth(measured_recall(rows, num / den))
    sets = rows.groupBy("cls").agg(F.min(F.struct("key", "n", "signature")).alias("r"), F.count("*").alias("copies"))
    reps = materialize(sets.select(F.col("r.key").alias("key"), F.col("r.n").alias("n"), F.col("r.signature").alias("signature"), "copies", "cls"))
    full = reps.where("n > 0")
    blocks = components(candidate_edges(full, depth, full.count())).select(F.col("node").alias("key"), F.col("root").alias("block"))
    members = materialize(blocks.join(reps.select("key", "copies", "n"), "key"))
    found = materialize(verify(members, docs, key, text_col, num, den, members.count()))
    if found.where("not whole").limit(1).collect():
        loose = components(found.where("not whole").select(F.col("key").alias("a"), F.col("root").alias("b")))
        roots = found.where("whole").select(F.col("key").alias("node"), "root").unionByName(loose)
        judged = found.groupBy("key").agg(F.sum("linked").alias("linked")).join(roots, F.col("key") == F.col("node"), "left").select("key", "linked", F.coalesce("root", "key").alias("root"))
    else:
        judged = found.select("key", "linked", "root")
    named = reps.select(F.col("key").alias("rep_key"), "cls", "copies").join(judged.withColumnRenamed("key", "rep_key"), "rep_key", "left")
    return rows.select("key", "cls").join(named, "cls").select(
        "key", F.coalesce("root", "rep_key").alias("class_key"), "rep_key", "copies", (F.col("copies") - 1 + F.coalesce("linked", F.lit(0))).alias("n_links")
    )


def join_near(docs: DataFrame, id_col: str, text_col: str, num: int = 4, den: int = 5) -> DataFrame:
    """One row for each document: id_col, class_id, rep_id, copies, n_links, class_row.

    Words are runs of ASCII letters (case folded), digits and characters beyond ASCII; a text of one to four words has one shingle,
    all its words; a text without words (null, empty) has no links and a class of its own. n_links counts the other documents with a Jaccard similarity of
    at least num / den; documents connected by links share class_id, the least id among them (of equal texts the one of the least id stands for all, so
    ties make no difference); rep_id is the least id with the same shingle set, copies how many have it. Where ids are null or repeated, rows go by
    a number in the order of ids (nulls first): class_row is the number of the class's first row and tells classes apart, class_id and rep_id are
    that row's id, null for a row without one. With unique ids class_row is class_id. An empty table gives no rows; other columns are not read.
    """
    key = fresh([id_col, text_col], "__key")
    numbered, same = keyed(docs.select(id_col, text_col), id_col, key, [text_col])
    out = classes(numbered, key, text_col, num, den)
    if same:
        return out.select(F.col("key").alias(id_col), F.col("class_key").alias("class_id"), F.col("rep_key").alias("rep_id"), "copies", "n_links", F.col("class_key").alias("class_row"))
    names = numbered.select(F.col(key).alias("row"), F.col(id_col).alias("id"))
    for column, name in (("key", "__own"), ("class_key", "__class"), ("rep_key", "__rep")):
        out = out.join(names.select(F.col("row").alias(column), F.col("id").alias(name)), column)
    return out.select(F.col("__own").alias(id_col), F.col("__class").alias("class_id"), F.col("__rep").alias("rep_id"), "copies", "n_links", F.col("class_key").alias("class_row"))


def keep_one(docs: DataFrame, id_col: str, text_col: str, num: int = 4, den: int = 5) -> DataFrame:
    """The rows of docs that stay, with all their columns: of each class of connected near copies the one of the least id (nulls first)."""
    key = fresh(docs.columns, "__key")
    numbered, _ = keyed(docs, id_col, key, [text_col])
    dropped = materialize(classes(numbered, key, text_col, num, den).where("key <> class_key").select(F.col("key").alias(key)))
    return semi_by_key(numbered, dropped, key, dropped.count(), "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query over all documents."""
    return join_near(spark.read.parquet(f"{sf_dir}/documents.parquet"), "doc_id", "text").drop("class_row")


OP3_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z0-9\x{80}-\x{10FFFF}]+') AS ws FROM documents),
s AS (SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
  ELSE list_sort(list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')))) END AS sh FROM w),
c AS (SELECT min(doc_id) AS rep_id, count(*) AS copies, CASE WHEN len(sh) = 0 THEN doc_id END AS alone, sh FROM s GROUP BY sh, alone),
e AS (SELECT rep_id, copies, len(sh) AS n, unnest(sh) AS g FROM c),
p AS (SELECT x.rep_id AS a, y.rep_id AS b, any_value(y.copies) AS copies FROM e x JOIN e y ON x.g = y.g AND x.rep_id <> y.rep_id AND 5 * y.n >= 4 * x.n AND 5 * x.n >= 4 * y.n
  GROUP BY x.rep_id, y.rep_id, x.n, y.n HAVING 9 * count(*) >= 4 * (x.n + y.n)),
r AS (SELECT a AS node, b AS root FROM p UNION SELECT r.node, p.b FROM r JOIN p ON p.a = r.root),
k AS (SELECT node, min(root) AS root FROM r GROUP BY node),
l AS (SELECT a, sum(copies)::BIGINT AS linked FROM p GROUP BY a)
SELECT s.doc_id, coalesce(least(k.root, c.rep_id), c.rep_id) AS class_id, c.rep_id, c.copies, c.copies - 1 + coalesce(l.linked, 0) AS n_links
FROM s JOIN c ON s.sh = c.sh AND (c.alone IS NULL OR c.alone = s.doc_id) LEFT JOIN k ON k.node = c.rep_id LEFT JOIN l ON l.a = c.rep_id
"""
