"""Near-duplicate detection with an LSH forest.

Every distinct shingle set gets one MinHash signature of 128 values.  The
forest has 16 trees; a tree orders all signatures by their values in an order
of its own.  Sets that agree on a tree's first three values share a region.
Candidates come in two rounds, and both are confirmed on full shingle sets:

1. Longest-common-prefix neighbours.  Each tree is sorted (range-partitioned,
   so a crowded region is cut at whatever depth its rows need) and adjacent
   sets of a region are compared by signature.  Every set keeps its likeliest
   neighbour, and every set of a crowded region meets that region's hub, the
   set with the smallest share of shingles of its own: a group of n copies is
   tied together by a few n checks.
2. The rest of each region.  A region whose sets are still in different
   components is worked off in blocks: sets outside the region's largest
   component against all of it, by signature; pairs inside one component are
   never made.  Nothing is capped, so no candidate of a region is lost.

Shingles that no other set of any region has are counted first.  They are in
no intersection, so of two sets with m and n shingles, of which at most c can
be common, the similarity is at most c / (m + n - c).  That takes sets with
many edits out of every region, and most pairs out of the second round,
without losing a link.

Two sets of similarity 0.85 miss a common region with probability
(1 - 0.85**3) ** 16 < 3e-7, and fall below the signature filter (five standard
deviations under the expected agreement, see ``agreeing``) with about as much.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from forkcast.llm import graph
from forkcast.llm.words import SPACED, Words, lower_ascii, mix, runs, shingles
from forkcast.session import materialize

VALUES, TREES, DEPTH = 128, 16, 3
#: Sets that meet in one block of a crowded region, on either side.
BLOCK = 1024
SHINGLE_WORDS = 5


def agreeing(least_percent: int) -> int:
    """Signature values that must agree before full sets are compared: five
    standard deviations under what sets just similar enough lead one to expect."""
    p = least_percent / 100
    return int(VALUES * p - 5 * (VALUES * p * (1 - p)) ** 0.5)


def _signer():
    """mapInArrow: (doc_id, text) -> sizes, set digests, region keys and signatures."""
    odd = mix(np.arange(1, VALUES + 1, dtype=np.uint64))
    times, plus = (odd >> np.uint64(32)).astype(np.uint32) | np.uint32(1), odd.astype(np.uint32)

    def sign(batches):
        for batch in batches:
            for lo, data, off in runs(batch.column(1)):
                words = Words(lower_ascii(data), off, SPACED)
                row, g = shingles(words, SHINGLE_WORDS)
                n = len(off) - 1
                size = np.bincount(row, minlength=n)
                full = np.flatnonzero(size)
                least = np.zeros((n, VALUES), np.uint32)
                if len(full):
                    at = np.searchsorted(row, full)
                    h = (g >> np.uint64(32)).astype(np.uint32)
                    for i in range(VALUES):
                        least[full, i] = np.minimum.reduceat((h ^ plus[i]) * times[i], at)
                keys = np.zeros((n, TREES), np.uint64)
                for t in range(TREES):
                    for d in range(DEPTH):
                        keys[:, t] = mix(keys[:, t] + least[:, t * DEPTH + d] + np.uint64(t + 1))
                signature = least.astype(np.uint8)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(lo, n), pa.array(size, pa.int64()),
                    *(pa.array(d) for d in _digests(row, g, n)),
                    pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * TREES), pa.array(keys.reshape(-1).view(np.int64))),
                    pa.array([s.tobytes() for s in signature], pa.binary()),
                ], names=["doc_id", "n_shingles", "d1", "d2", "keys", "sig"])
    return sign


def signatures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, d1, d2 (together the identity of the shingle set),
    keys (a region key per tree), sig; one row per input row."""
    two = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return two.mapInArrow(_signer(), "doc_id long, n_shingles long, d1 long, d2 long, keys array<long>, sig binary")


def _matrix(column: pa.Array) -> np.ndarray:
    """Signatures as a matrix of bytes."""
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, VALUES)


def _neighbours(least_percent: int):
    """mapInArrow over rows sorted by (tree, key, label): adjacent rows of a region that agree often enough."""
    enough = agreeing(least_percent)

    def neighbours(batches):
        last = None
        for batch in batches:
            if not batch.num_rows:
                continue
            region = np.stack([batch.column(i).to_numpy().astype(np.int64) for i in (0, 1)], 1)
            rep, label = batch.column(2).to_numpy(), _matrix(batch.column(3))
            if last is not None:
                region, rep, label = (np.concatenate([a, b]) for a, b in zip(last, (region, rep, label)))
            last = region[-1:], rep[-1:], label[-1:]
            agree = (label[1:] == label[:-1]).sum(1)
            ok = (agree >= enough) & (region[1:] == region[:-1]).all(1) & (rep[1:] != rep[:-1])
            a, b = rep[:-1][ok], rep[1:][ok]
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b)), pa.array(agree[ok].astype(np.int32))], names=["a", "b", "agree"])
    return neighbours


def _possible(n1, c1, n2, c2, least_percent: int):
    """Whether sets of n1 and n2 shingles, c1 and c2 of them not their own alone, can be similar enough."""
    c = np.minimum(c1, c2)
    return 100 * c >= least_percent * (n1 + n2 - c)


def _alike(least_percent: int):
    """mapInArrow: (a, b, n, c, sig of a, of b) -> the pairs (a, b) that agree often enough and can be similar enough."""
    enough = agreeing(least_percent)

    def alike(batches):
        for batch in batches:
            if batch.num_rows:
                n1, c1, n2, c2 = (batch.column(i).to_numpy() for i in (2, 3, 4, 5))
                agree = (_matrix(batch.column(6)) == _matrix(batch.column(7))).sum(1)
                ok = pa.array((agree >= enough) & _possible(n1, c1, n2, c2, least_percent))
                yield pa.RecordBatch.from_arrays([batch.column(0).filter(ok), batch.column(1).filter(ok)], names=["a", "b"])
    return alike


#: Roles in a block: of the region's largest component, of another one, the latter asking.
HOME, OTHER, ASKS = 0, 1, 2


def _cross(least_percent: int):
    """mapInArrow over rows sorted by (block, role): in each block, every
    asking set against every set of another component.  A pair that shares
    regions of several trees is made in the first one only."""
    enough = agreeing(least_percent)

    def out(rows):
        tree, role, rep, comp, n, c, keys, sig = (np.concatenate(x) for x in zip(*rows))
        d = np.flatnonzero(role != ASKS)
        found = []
        for i in np.flatnonzero(role == ASKS):
            near = d[(comp[d] != comp[i]) & ((role[d] == HOME) | (rep[d] < rep[i])) & _possible(n[d], c[d], n[i], c[i], least_percent)]
            near = near[(sig[near] == sig[i]).sum(1) >= enough]
            other = rep[near[~(keys[near, :tree[i]] == keys[i, :tree[i]]).any(1)]]
            if len(other):
                found.append((np.minimum(other, rep[i]), np.maximum(other, rep[i])))
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*found)], names=["a", "b"])

    def cross(batches):
        held, block = [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            key = batch.column(0).to_numpy()
            cols = (*(batch.column(i).to_numpy() for i in range(1, 7)), batch.column(7).flatten().to_numpy().reshape(-1, TREES), _matrix(batch.column(8)))
            edges = [0, *(np.flatnonzero(key[1:] != key[:-1]) + 1), len(key)]
            for lo, hi in zip(edges[:-1], edges[1:]):
                if key[lo] != block and held:
                    yield from out(held)
                    held = []
                block = key[lo]
                held.append(tuple(x[lo:hi] for x in cols))
        if held:
            yield from out(held)
    return cross


def _digests(row: np.ndarray, g: np.ndarray, n: int) -> np.ndarray:
    """Two 64-bit digests of every row's set (0 for the empty set)."""
    out = np.zeros((2, n), np.uint64)
    full = np.flatnonzero(np.bincount(row, minlength=n))
    if len(full):
        at = np.searchsorted(row, full)
        for i, salt in enumerate((0x51ED270B7F4A7C15, 0x2545F4914F6CDD1D)):
            out[i, full] = np.add.reduceat(mix(g ^ np.uint64(salt)), at)
    return out.view(np.int64)


def _with_digests(place: int, names: list[str]):
    """mapInArrow: rows with d1, d2 of the text in column ``place``."""
    def add(batches):
        for batch in batches:
            for lo, data, off in runs(batch.column(place).cast(pa.string())):
                row, g = shingles(Words(lower_ascii(data), off, SPACED), SHINGLE_WORDS)
                n = len(off) - 1
                yield pa.RecordBatch.from_arrays([*batch.slice(lo, n).columns, *(pa.array(d) for d in _digests(row, g, n))], names=[*names, "set_d1", "set_d2"])
    return add


def with_digests(rows: DataFrame, text_col: str) -> DataFrame:
    """``rows`` with set_d1, set_d2, the identity of a text's shingle set."""
    names = rows.columns
    schema = T.StructType([*rows.schema.fields, T.StructField("set_d1", T.LongType()), T.StructField("set_d2", T.LongType())])
    return rows.mapInArrow(_with_digests(names.index(text_col), names), schema)


def _shingle_lists(batches):
    """mapInArrow: (rep, text) -> rep, its distinct shingles."""
    for batch in batches:
        for lo, data, off in runs(batch.column(1)):
            row, g = shingles(Words(lower_ascii(data), off, SPACED), SHINGLE_WORDS)
            n = len(off) - 1
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, n), pa.ListArray.from_arrays(pa.array(np.searchsorted(row, np.arange(n + 1)), pa.int32()), pa.array(g.view(np.int64)))], names=["rep", "shingles"])


def _confirm(least_percent: int):
    """mapInArrow: (a, b, text_a, text_b) -> the pairs whose full shingle sets are similar enough."""
    def sets(texts: pa.Array):
        for lo, data, off in runs(texts):
            row, g = shingles(Words(lower_ascii(data), off, SPACED), SHINGLE_WORDS)
            yield row + lo, g

    def confirm(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                n = part.num_rows
                sides = [tuple(np.concatenate(x) for x in zip(*sets(part.column(i)))) for i in (2, 3)]
                row, g = (np.concatenate(x) for x in zip(*sides))
                order = np.lexsort((g, row))
                row, g = row[order], g[order]
                both = np.bincount(row[1:][(row[1:] == row[:-1]) & (g[1:] == g[:-1])], minlength=n)
                union = np.bincount(row, minlength=n) - both
                ok = pa.array((100 * both >= least_percent * union) & (union > 0))
                yield pa.RecordBatch.from_arrays([part.column(0).filter(ok), part.column(1).filter(ok)], names=["a", "b"])
    return confirm


def confirmed(pairs: DataFrame, texts: DataFrame, least_percent: int) -> DataFrame:
    """The pairs (a, b) whose full shingle sets have 100 * intersection >=
    least_percent * union; texts: (rep, text)."""
    a = texts.select(F.col("rep").alias("a"), F.col("text").alias("text_a"))
    b = texts.select(F.col("rep").alias("b"), F.col("text").alias("text_b"))
    both = pairs.select("a", "b").join(a, "a").join(b, "b").select("a", "b", "text_a", "text_b")
    return both.mapInArrow(_confirm(least_percent), "a long, b long")


def _rest(members: DataFrame, able: DataFrame, comps: DataFrame, least_percent: int) -> DataFrame:
    """Candidate pairs (a, b) across the components that still share a region."""
    m = (members.join(comps.select(F.col("id").alias("rep"), "component"), "rep", "left")
         .withColumn("component", F.coalesce("component", "rep")))
    open_ = (m.groupBy("tree", "key", "component").agg(F.count("*").alias("n"))
             .groupBy("tree", "key").agg(F.count("*").alias("parts"), F.sum("n").alias("n"), F.max_by("component", F.struct("n", "component")).alias("home"), F.max("n").alias("most"))
             .where("parts > 1")
             .select("tree", "key", "home", F.ceil(F.col("n") / BLOCK).alias("down"), F.ceil((F.col("n") - F.col("most")) / BLOCK).alias("across")))
    m = m.join(open_, ["tree", "key"])
    upto = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    own = m.select("rep", "component", F.when(F.col("component") == F.col("home"), HOME).otherwise(OTHER).alias("role"), "tree", "key", F.pmod(F.xxhash64("rep"), "down").alias("i"), upto("across").alias("j"))
    ask = m.where("component <> home").select("rep", "component", F.lit(ASKS).alias("role"), "tree", "key", upto("down").alias("i"), F.pmod(F.xxhash64("rep", F.lit(7)), "across").alias("j"))
    rows = own.unionAll(ask).select(F.xxhash64("tree", "key", "i", "j").alias("block"), "tree", "role", "rep", "component").join(able, "rep")
    return (rows.select("block", "tree", "role", "rep", "component", "n", "c", "keys", "sig").repartition("block").sortWithinPartitions("block", "role")
            .mapInArrow(_cross(least_percent), "a long, b long").distinct())


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_percent: int = 85) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(signed, sets, links): ``signatures`` of all rows; rep, first_id, d1,
    d2 of every distinct non-empty shingle set (rep is a number of its own,
    first_id the smallest id that has it); links (a, b) between reps.

    Sets are told apart by their digests alone, so ids that stand on several
    texts confuse nothing."""
    signed = materialize(signatures(docs, id_col, text_col), "signed")
    reps = materialize(signed.where("n_shingles > 0 and doc_id is not null").groupBy("d1", "d2")
                       .agg(F.min("doc_id").alias("first_id"), F.first("n_shingles").alias("n"), F.first("keys").alias("keys"), F.first("sig").alias("sig"))
                       .withColumn("rep", F.monotonically_increasing_id()), "reps")
    places = reps.select("rep", F.posexplode("keys").alias("tree", "key"))
    shared = places.groupBy("tree", "key").agg(F.count("*").alias("sets")).where("sets > 1").drop("sets")
    members = materialize(places.join(shared, ["tree", "key"]), "regions")
    wanted = reps.select("rep", "first_id", "d1", "d2").join(members.select("rep").distinct(), "rep", "left_semi")
    found = (docs.select(F.col(id_col).cast("long").alias("first_id"), F.col(text_col).cast("string").alias("text"))
             .join(wanted.select("first_id").distinct().hint("merge"), "first_id", "left_semi"))  # ids grow with the corpus: never broadcast
    found = with_digests(found, "text").withColumnsRenamed({"set_d1": "d1", "set_d2": "d2"}).join(wanted, ["first_id", "d1", "d2"])
    texts = materialize(found.groupBy("rep").agg(F.first("text").alias("text")), "texts")

    every = texts.mapInArrow(_shingle_lists, "rep long, shingles array<long>").select("rep", F.explode("shingles").alias("shingle"))
    own = (every.groupBy("shingle").agg(F.count("*").alias("sets"), F.min("rep").alias("rep")).where("sets = 1")
           .groupBy("rep").agg(F.count("*").alias("own")))
    able = (reps.select("rep", "n", "keys", "sig").join(members.select("rep").distinct(), "rep", "left_semi").join(own, "rep", "left")
            .select("rep", "n", (F.col("n") - F.coalesce("own", F.lit(0))).alias("c"), "keys", "sig").where(100 * F.col("c") >= least_percent * F.col("n")))
    able = materialize(able, "able")
    members = members.join(able.select("rep", (F.col("c") / F.col("n")).alias("common")), "rep")
    regions = members.groupBy("tree", "key").agg(F.count("*").alias("sets"), F.max_by("rep", F.struct("common", -F.col("rep"))).alias("hub")).where("sets > 1")
    members = materialize(members.join(regions, ["tree", "key"]).select("tree", "key", "rep", "sets", "hub"), "regions")

    skip = F.col("tree") * DEPTH + DEPTH
    label = F.concat(F.col("sig").substr(skip + 1, F.lit(VALUES)), F.col("sig").substr(F.lit(1), skip))
    ordered = (members.join(able.select("rep", "sig"), "rep").select("tree", "key", "rep", label.alias("label"))
               .repartitionByRange("tree", "key", "label", "rep").sortWithinPartitions("tree", "key", "label", "rep"))
    near = ordered.mapInArrow(_neighbours(least_percent), "a long, b long, agree int").distinct()
    sides = near.unionAll(near.select(F.col("b").alias("a"), F.col("a").alias("b"), "agree"))
    best = sides.groupBy("a").agg(F.max_by("b", F.struct("agree", "b")).alias("b"))
    star = members.where("sets > 3 and rep <> hub").select(F.least("rep", "hub").alias("a"), F.greatest("rep", "hub").alias("b")).distinct()
    side = lambda x: able.select(F.col("rep").alias(x), F.col("n").alias(f"n_{x}"), F.col("c").alias(f"c_{x}"), F.col("sig").alias(f"sig_{x}"))
    star = star.join(side("a"), "a").join(side("b"), "b").select("a", "b", "n_a", "c_a", "n_b", "c_b", "sig_a", "sig_b").mapInArrow(_alike(least_percent), "a long, b long")
    first = best.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).unionAll(star).distinct()
    links = materialize(confirmed(first, texts, least_percent), "links")
    comps = materialize(graph.components(links), "components")
    more = materialize(confirmed(_rest(members, able, comps, least_percent), texts, least_percent), "links")
    return signed, reps.select("rep", "first_id", "d1", "d2"), links.unionAll(more)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_percent: int = 85) -> DataFrame:
    """doc_id, n_shingles, component_id, kept; one row per input row.

    Texts are lower-cased (A-Z) and split at white space; a document's set is
    its distinct 5-word shingles, or its whole sequence if that is shorter.
    Documents with 100 * intersection >= least_percent * union are linked;
    component_id is the smallest id reachable, kept marks that document.

    Null or empty texts and texts without words have the empty set and are
    linked with nothing.  Rows with a null id are linked with nothing: their
    component is null and they are kept.  Rows that share an id count as one
    document with all their links; those of them without words stay on their
    own.  An empty table gives an empty result; columns besides id and text
    are ignored, whatever their names.
    """
    signed, sets, links = classes(docs, id_col, text_col, least_percent)
    # ids that stand on several sets: the sets are one document's
    several = signed.where("n_shingles > 0 and doc_id is not null").groupBy("doc_id").agg(F.min(F.struct("d1", "d2")).alias("low"), F.max(F.struct("d1", "d2")).alias("high")).where("low <> high")
    of_id = signed.where("n_shingles > 0").select("doc_id", "d1", "d2").join(several.select("doc_id"), "doc_id", "left_semi").distinct().join(sets.select("rep", "d1", "d2"), ["d1", "d2"])
    tied = of_id.join(of_id.groupBy("doc_id").agg(F.min("rep").alias("b")), "doc_id").select(F.col("rep").alias("a"), "b")
    comps = graph.components(links.unionAll(tied)).select(F.col("id").alias("rep"), "component")
    named = sets.join(comps, "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    smallest = named.groupBy("component").agg(F.min("first_id").alias("component_id"))
    named = named.join(smallest, "component").select("d1", "d2", F.col("component_id").alias("of_set"))
    out = signed.select("doc_id", "n_shingles", "d1", "d2").join(named, ["d1", "d2"], "left")
    component = F.when(F.col("doc_id").isNull(), None).when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("of_set"))
    return out.select("doc_id", "n_shingles", component.alias("component_id")).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_percent: int = 80) -> DataFrame:
    """The rows of ``docs``, all columns, one of each group of near duplicates:
    the one with the smallest id.

    Rows are judged by their texts, so rows that share an id go or stay each
    by its own; of rows with one id and one shingle set (also the empty one)
    one stays.  Rows with a null id all stay.  Columns named set_d1, set_d2
    are taken.  An empty table gives an empty result.
    """
    signed, sets, links = classes(docs, id_col, text_col, least_percent)
    comps = graph.components(links).select(F.col("id").alias("rep"), "component")
    named = sets.join(comps, "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    chosen = named.groupBy("component").agg(F.min(F.struct("first_id", "rep")).alias("first"))
    stays = named.join(chosen, "component").where(F.col("rep") == F.col("first.rep")).select("d1", "d2", F.col("first_id").alias("stays"))
    gone = (signed.where("n_shingles > 0 and doc_id is not null").select("doc_id", "d1", "d2").distinct().join(stays, ["d1", "d2"], "left")
            .where("stays is null or doc_id <> stays").select(F.col("doc_id").alias("gone_id"), F.col("d1").alias("gone_d1"), F.col("d2").alias("gone_d2")).hint("merge"))
    rows = with_digests(docs, text_col)
    same = [rows[id_col].cast("long") == F.col("gone_id"), rows["set_d1"] == F.col("gone_d1"), rows["set_d2"] == F.col("gone_d2")]
    stay = rows.where(F.col(id_col).isNotNull()).join(gone, same, "left_anti")
    return stay.dropDuplicates([id_col, "set_d1", "set_d2"]).drop("set_d1", "set_d2").unionByName(docs.where(F.col(id_col).isNull()))
