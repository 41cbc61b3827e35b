"""Prefix trie of rebuilt conversations, from composable fingerprints; no rebuilt text is ever written out.

The product of a run of turns is a polynomial in a base, modulo primes. Products compose: that of a head followed by
a suffix is head + suffix * base ** length. So a rebuilt conversation's prefixes follow from the running products
of its base conversation and its own, which are computed once per stored turn.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paywatch.llm.common import sized, stage
from paywatch.llm.ordering import dealt

# Every conversation starts with up to HEADS - 1 turns of the first one of its FAMILY.
FAMILY = 5
HEADS = 9
# Ids of conversations that end at one node are joined in chunks of this many.
CHUNK_IDS = 1000
DIGITS = 6  # a power is looked up by digits of this many bits
# The three largest primes below 2 ** 31.
PRIMES = (2147483647, 2147483629, 2147483587)
DIGESTS = 200_000  # rows with a digest, about 100 bytes each, that are broadcast
NODE = ["depth", "fa", "fb"]


class Draw(NamedTuple):
    """One choice of hash seeds, primes and bases; `bits` is the length of a turn's two hashes."""

    seed: int
    primes: tuple[int, int, int] = PRIMES
    bits: int = 64

    def base(self, i: int) -> int:
        digest = hashlib.sha256(f"{self.seed}:{i}".encode()).digest()
        return int.from_bytes(digest[:8], "big") % (self.primes[i] - 2) + 2

    def hashed(self, i: int, *values: Column) -> Column:
        return F.shiftrightunsigned(F.xxhash64(F.lit(self.seed * 16 + i), *values), 64 - self.bits) if self.bits < 64 else F.xxhash64(F.lit(self.seed * 16 + i), *values)


DRAWS = tuple(Draw(seed) for seed in range(1, 6))


def _power(exponent: Column, base: int, prime: int, digits: int) -> Column:
    """base ** exponent modulo prime, by table look-up of the exponent's digits."""
    size = 1 << DIGITS
    out = None
    for d in range(digits):
        table = F.array(*(F.lit(pow(base, v << (DIGITS * d), prime)) for v in range(size)))
        digit = F.shiftrightunsigned(exponent, DIGITS * d).bitwiseAND(F.lit(size - 1)).cast("int")
        factor = F.get(table, digit).cast("long")
        out = factor if out is None else (out * factor) % prime
    return out


def stored_turns(conversations: DataFrame, draw: Draw) -> DataFrame:
    """(ref, conv_id, turn, k1, k2, n_bytes, role, text): the turns, stored, each with a reference and two hashes."""
    role, text = F.coalesce(F.col("role"), F.lit("")), F.coalesce(F.col("text"), F.lit(""))
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.monotonically_increasing_id().alias("ref"),
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        draw.hashed(1, role, text).alias("k1"),
        draw.hashed(2, role, text).alias("k2"),
        F.octet_length(text).cast("long").alias("n_bytes"),
        role.alias("role"),
        text.alias("text"),
    )
    return stage(rows, "turns")


def hashes_name_turns(turns: DataFrame) -> bool:
    """Whether stored turns with the same two hashes are equal in role and text, compared as they are.

    Only turns whose hashes occur more than once are compared; copies fall together before the shuffle.
    """
    repeated = turns.groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("k1", "k2")
    same = turns.join(sized(stage(repeated, "repeated")), ["k1", "k2"], "left_semi").groupBy("k1", "k2")
    ends = same.agg(F.min("role").alias("r0"), F.max("role").alias("r1"), F.min("text").alias("t0"), F.max("text").alias("t1"))
    return ends.where("r0 != r1 or t0 != t1").isEmpty()


def running_products(turns: DataFrame, draw: Draw) -> DataFrame:
    """(conv_id, j, ref, k1, k2, n_bytes, g0, g1, g2, upto): the j-th turn of a conversation, from 1, with the product
    and the bytes of all turns up to it.

    A conversation of any length is cut into slices. Each slice has its own products; a later one's start from the
    composed product of the slices before it, one row per slice of the few conversations that have several.
    """
    order = ["turn", "k1", "k2", "ref"]
    rows = dealt(turns.select("conv_id", *order, "n_bytes"), ["conv_id", *order], "turns-dealt")
    part = Window.partitionBy("conv_id", "slice").orderBy(F.col("turn").asc_nulls_first(), "k1", "k2", "ref")
    so_far = part.rowsBetween(Window.unboundedPreceding, 0)
    local = rows.withColumn("j", F.row_number().over(part).cast("long"))
    for i, prime in enumerate(draw.primes):
        letter = F.pmod(draw.hashed(3 + i, F.col("k1"), F.col("k2")), F.lit(prime))
        term = (letter * _power(F.col("j"), draw.base(i), prime, 4)) % prime
        local = local.withColumn(f"g{i}", F.sum(term).over(so_far) % prime)
    local = stage(local.withColumn("upto", F.sum("n_bytes").over(so_far)).drop("turn"), "products")

    all_ = Window.partitionBy("conv_id")
    before = all_.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    sums = {c: F.max_by(c, "j").alias(c) for c in ("g0", "g1", "g2", "upto")}
    # A conversation in several slices fills the borders between them: there are fewer than two rows a slice.
    several = local.groupBy("conv_id").agg(F.min("slice").alias("first"), F.max("slice").alias("last")).where("first < last").select("conv_id")
    each = local.join(sized(several), "conv_id", "left_semi").groupBy("conv_id", "slice").agg(F.max("j").alias("n"), *sums.values())
    zero = F.lit(0).cast("long")
    each = each.withColumn("o_n", F.coalesce(F.sum("n").over(before), zero))
    carry = each.select(
        F.col("conv_id").alias("o_conv"),
        F.col("slice").alias("o_slice"),
        "o_n",
        F.coalesce(F.sum("upto").over(before), zero).alias("o_upto"),
        *(
            (F.coalesce(F.sum((F.col(f"g{i}") * _power(F.col("o_n"), draw.base(i), p, 6)) % p).over(before), zero) % p).alias(f"o_g{i}")
            for i, p in enumerate(draw.primes)
        ),
        *(_power(F.col("o_n"), draw.base(i), p, 6).alias(f"o_m{i}") for i, p in enumerate(draw.primes)),
    )
    carry = stage(carry, "carry")
    joined = local.join(sized(carry), (F.col("conv_id") == F.col("o_conv")) & (F.col("slice") == F.col("o_slice")), "left")
    moved = {f"g{i}": F.when(F.col("o_n").isNull(), F.col(f"g{i}")).otherwise((F.col(f"o_g{i}") + F.col(f"g{i}") * F.col(f"o_m{i}")) % p) for i, p in enumerate(draw.primes)}
    return joined.select(
        "conv_id",
        (F.col("j") + F.coalesce("o_n", zero)).alias("j"),
        "ref", "k1", "k2", "n_bytes",
        *(e.alias(n) for n, e in moved.items()),
        (F.col("upto") + F.coalesce("o_upto", zero)).alias("upto"),
    )


def heads(conv_id: Column) -> Column:
    """How many turns a rebuilt conversation takes from the first of its family."""
    return (F.crc32(conv_id.cast("string").cast("binary")) % HEADS).cast("int")


def memberships(turns: DataFrame, draw: Draw) -> DataFrame:
    """(conv_id, depth, fa, fb, k1, k2, n_bytes, upto, ends): every rebuilt conversation at each of its prefixes.

    (fa, fb) is the prefix's product, (k1, k2) and n_bytes belong to its last turn, `upto` are the bytes of the whole
    prefix, `ends` says that the conversation ends there. Stored; no text is read.
    """
    products = running_products(turns, draw)
    state = [f"g{i}" for i in range(3)] + ["upto"]
    h = heads(F.col("conv_id"))
    own = products.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"), *(F.coalesce(F.max(F.when(F.col("j") == h, F.col(c))), F.lit(0)).alias(f"own_{c}") for c in state))
    first = products.where((F.col("conv_id") % FAMILY == 0) & (F.col("j") < HEADS))
    kept = F.struct("j", "k1", "k2", "n_bytes", *state)
    first = first.groupBy(F.col("conv_id").alias("of")).agg(F.array_sort(F.collect_list(kept)).alias("all"))  # HEADS - 1 at most
    joined = own.withColumn("h", h).join(first, F.col("conv_id") - F.col("conv_id") % FAMILY == F.col("of"), "left")
    none = F.array().cast("array<struct<j:bigint,k1:bigint,k2:bigint,n_bytes:bigint,g0:bigint,g1:bigint,g2:bigint,upto:bigint>>")
    joined = joined.withColumn("head", F.slice(F.coalesce("all", none), F.lit(1), F.col("h"))).withColumn("hb", F.size("head").cast("long"))
    length = F.col("hb") + F.greatest(F.col("n") - F.col("h"), F.lit(0))
    last = F.try_element_at("head", F.lit(-1))
    info = joined.select("conv_id", "h", "hb", "head", length.alias("length"), *(f"own_{c}" for c in state), *(F.coalesce(last[c], F.lit(0)).alias(f"base_{c}") for c in state))
    info = stage(info, "rebuilt")

    def rows(df: DataFrame, depth: Column, g: Sequence[Column], upto: Column, last: Sequence[Column]) -> DataFrame:
        packed = F.shiftleft(g[0], 31) + g[1]
        named = zip(("k1", "k2", "n_bytes"), last)
        return df.select("conv_id", depth.cast("long").alias("depth"), packed.alias("fa"), g[2].alias("fb"), *(c.cast("long").alias(n) for n, c in named), upto.cast("long").alias("upto"), (depth == F.col("length")).alias("ends"))

    zero = F.lit(0).cast("long")
    root = rows(info, zero, [zero] * 3, zero, [zero] * 3)
    head = info.select("conv_id", "length", F.inline("head"))
    head = rows(head, F.col("j"), [F.col(f"g{i}") for i in range(3)], F.col("upto"), [F.col(c) for c in ("k1", "k2", "n_bytes")])
    own_part = products.join(info.drop("head"), "conv_id").where(F.col("j") > F.col("h"))
    moved = []
    for i, p in enumerate(draw.primes):
        back = F.array(*(F.lit(pow(draw.base(i), -k, p)).cast("long") for k in range(HEADS)))
        suffix = F.pmod(F.col(f"g{i}") - F.col(f"own_g{i}"), F.lit(p)) * F.get(back, (F.col("h") - F.col("hb")).cast("int"))
        moved.append((F.col(f"base_g{i}") + suffix % p) % p)
    suffix = rows(own_part, F.col("hb") + F.col("j") - F.col("h"), moved, F.col("base_upto") + F.col("upto") - F.col("own_upto"), [F.col(c) for c in ("k1", "k2", "n_bytes")])
    return stage(root.unionByName(head).unionByName(suffix), "memberships")


def _nodes(members: DataFrame) -> DataFrame:
    """(depth, fa, fb, owner, n, n_ends, same), stored: groups of one product, and whether their last turns agree."""
    same = (F.min("k1") == F.max("k1")) & (F.min("k2") == F.max("k2"))
    return stage(members.groupBy(*NODE).agg(
        F.min("conv_id").alias("owner"), F.count(F.lit(1)).alias("n"), F.count_if("ends").alias("n_ends"), same.alias("same")
    ), "nodes")


def _checked(conversations: DataFrame, draws: Sequence[Draw]) -> tuple[DataFrame, DataFrame]:
    """Memberships and nodes whose groups hold equal prefixes.

    The last turns of a group must refer to equal stored turns. The product before the last turn follows from the
    product and that turn, so it is the same in a group, and the parents' group has passed the same check: by
    induction the whole prefixes are equal. Should a group fail, all is computed anew with other seeds.
    """
    for draw in draws:
        turns = stored_turns(conversations, draw)
        if not hashes_name_turns(turns):
            continue
        members = memberships(turns, draw)
        nodes = _nodes(members)
        if nodes.where(~F.col("same")).isEmpty():
            return members, nodes
    raise ValueError("no draw of hash seeds told all prefixes apart")


def _hash_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 over the chunks of a node, which come one after the other: memory does not grow with the node."""
    last, state = None, None
    for batch in batches:
        done = []
        columns = [batch.column(c).to_pylist() for c in (*NODE, "ids")]
        for *node, ids in zip(*columns):
            if node != last:
                if last is not None:
                    done.append((*last, state.hexdigest()))
                last, state = node, hashlib.sha256()
            else:
                state.update(b",")
            state.update(ids.encode())
        if done:
            yield pa.record_batch([pa.array(c) for c in zip(*done)], names=[*NODE, "digest"])
    if last is not None:
        yield pa.record_batch([pa.array([c]) for c in (*last, state.hexdigest())], names=[*NODE, "digest"])


def _sha(string: Column) -> Column:
    return F.sha2(string.cast("binary"), 256)


def end_digests(members: DataFrame, nodes: DataFrame) -> DataFrame:
    """(depth, fa, fb, digest) of the nodes where several conversations end: SHA-256 of their ids, ascending, comma-joined.

    Ids are dealt by range and joined in chunks where they lie; a node of one chunk is hashed by SQL, one of many
    chunks is streamed through one hash, a row for each CHUNK_IDS conversations.
    """
    many = stage(nodes.where("n_ends > 1").select(*NODE), "ended")
    ends = stage(members.where("ends").join(sized(many), NODE, "left_semi").select(*NODE, "conv_id"), "ends")
    rows = dealt(ends, [*NODE, "conv_id"], "ends-dealt")
    place = F.row_number().over(Window.partitionBy(*NODE, "slice").orderBy("conv_id"))
    rows = rows.withColumn("chunk", F.floor((place - 1) / CHUNK_IDS))
    ids = F.array_join(F.transform(F.array_sort(F.collect_list("conv_id")), lambda c: c.cast("string")), ",")
    chunks = stage(rows.groupBy(*NODE, "slice", "chunk").agg(ids.alias("ids")), "chunks")
    sizes = chunks.groupBy(*NODE).agg(F.count(F.lit(1)).alias("k"), F.max("ids").alias("ids"))
    one = sizes.where("k = 1").select(*NODE, _sha(F.col("ids")).alias("digest"))
    large = sizes.where("k > 1").select(*NODE)  # one row for CHUNK_IDS conversations or a slice's border at most
    streamed = chunks.join(sized(stage(large, "large")), NODE, "left_semi").repartition(*NODE).sortWithinPartitions(*NODE, "slice", "chunk")
    return one.unionByName(streamed.select(*NODE, "ids").mapInArrow(_hash_chunks, "depth long, fa long, fb long, digest string"))


def trie(conversations: DataFrame, draws: Sequence[Draw] = DRAWS) -> DataFrame:
    """One row per distinct prefix of the rebuilt conversations: conv_id, depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256.

    A conversation is rebuilt from the first turns of the first one of its family and its own turns after as many.
    Turns go by `turn`, null first; turns of one number by a hash of role and text. A null role or text is empty; a
    row without a conv_id belongs to no conversation and is left out; repeated rows are turns like any other. An
    empty table has no node. Other columns are not read. A text is read where it is stored and shuffled only if
    its hash occurs more than once; a very long one costs its own size.

    A node belongs to its smallest member, and so do all later ones on that member's path. Sums over a subtree are
    therefore sums over the members of its top: each knows the depth from which its path is its own, whether it ends
    in a leaf of its own, and how many bytes it shares with a smaller conversation.
    """
    members, nodes = _checked(conversations, draws)
    shared = stage(nodes.where("n > 1").select(*NODE, "owner", (F.col("n") == F.col("n_ends")).alias("childless")), "shared")
    mine = F.col("owner") == F.col("conv_id")
    owned = members.join(sized(shared), NODE, "left").withColumns({
        "owner": F.coalesce("owner", "conv_id"), "childless": F.coalesce("childless", "ends")
    })
    # Along a path owners ascend, so the deepest node of another one has the largest owner and the most bytes.
    per = stage(owned.groupBy("conv_id").agg(
        F.min(F.when(mine, F.col("depth"))).alias("own"),
        F.max(F.when(~mine, F.col("owner"))).alias("above"),
        F.coalesce(F.max(F.when(~mine, F.col("upto"))), F.lit(0)).alias("common"),
        F.max((mine & F.col("ends") & F.col("childless")).cast("int")).alias("leaf"),
    ), "paths")
    rows = members.join(sized(per), "conv_id")
    is_own = F.coalesce(F.col("own") <= F.col("depth"), F.lit(False))
    opens = F.coalesce(F.col("own") <= F.col("depth") + 1, F.lit(False)) & ~F.col("ends")
    totals = rows.groupBy(*NODE).agg(
        F.min("conv_id").alias("conv_id"),
        F.max(F.when(is_own, F.when(F.col("own") == F.col("depth"), F.col("above")).otherwise(F.col("conv_id")))).alias("parent_conv_id"),
        F.count(F.lit(1)).alias("n_convs"),
        F.count_if(opens).alias("n_children"),
        F.sum("leaf").alias("n_leaves"),
        F.sum(F.greatest(F.lit(0), F.col("common") - F.col("upto") + F.col("n_bytes"))).alias("saved_tokens"),
        F.max(F.when(F.col("ends"), F.col("conv_id"))).alias("end"),
    )
    digests = stage(end_digests(members, nodes), "digests")
    digests = F.broadcast(digests) if digests.count() <= DIGESTS else digests
    alone = F.coalesce(F.col("end").cast("string"), F.lit(""))
    return totals.join(digests, NODE, "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("digest", _sha(alone)).alias("ends_sha256"),
    )
