"""The users that share most campaigns with each user, by inverted lists with a prefix filter.

Users with the same campaigns are one set, so sets are searched instead of users. A set's campaigns are ordered from the one
with the fewest users to the one with the most. If two sets share at least w campaigns, the second has one of the first
|A| - w + 1 campaigns of the first, A; only the lists of those, its prefix, need be looked into. How large w may be follows from the
k + 1 smallest users of each campaign: whoever is listed for m campaigns of A shares m with it at least, so no neighbour of A shares
fewer than the (k + 1)-th largest m.

A campaign of all users is the last in its sets, and so in a prefix only where a single common campaign would do. There its k + 1
smallest users are enough, as ties go to the smaller id. What is shuffled are sets and the blocks of prefixes that they meet.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parley.operators.graph import user_campaigns
from parley.operators.joins import lookup_join
from parley.operators.pairs import PRODUCT_GAIN, token_products
from parley.session import materialize

# Sets that ask together, and sets that they are compared with in one task.
ASKING = 1000
COMPARED = 10_000
# Groups of sets that ask, and of those compared with each, that a table of sets is cut into at most: so often is a set copied.
MOST_GROUPS = 16
# Pairs of sets that a task looks at together.
PAIRS = 1 << 22


def _campaign_sets(df: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
    """(set, tokens, size, low, ids) with the k + 1 smallest users ``ids``, and (userid, set); campaigns of one user are left out.

    A token is a campaign's place by (users, name), so a set's tokens in order go from rare to frequent.
    """
    pairs = materialize(user_campaigns(df), "user_campaigns")
    shared = pairs.groupBy("campaign").agg(F.count("*").alias("n")).filter("n > 1")
    # numbers of a sorted table rise with its order
    tokens = materialize(shared.orderBy("n", "campaign").select("campaign", F.monotonically_increasing_id().alias("token")), "tokens")
    placed = lookup_join(pairs, tokens, ["campaign"], "userid")
    # as long as a user has different campaigns
    users = materialize(placed.groupBy("userid").agg(F.array_sort(F.collect_list("token")).alias("tokens")), "user_tokens")
    sets = materialize(users.select("tokens").distinct().withColumn("set", F.monotonically_increasing_id()), "set_numbers")
    members = materialize(lookup_join(users, sets, ["tokens"], "userid").select("userid", "set"), "members")
    nth = F.row_number().over(Window.partitionBy("set").orderBy("userid"))
    first = members.withColumn("nth", nth).filter(F.col("nth") <= k + 1).groupBy("set").agg(F.array_sort(F.collect_list("userid")).alias("ids"))
    full = sets.join(first, "set").select("set", "tokens", F.size("tokens").alias("size"), F.element_at("ids", 1).alias("low"), "ids")
    return materialize(full, "sets"), members


def _listed_users(sets: DataFrame, k: int) -> DataFrame:
    """(token, userid): the k + 1 smallest users of each campaign."""
    users = sets.select(F.explode("tokens").alias("token"), "ids").select("token", F.explode("ids").alias("userid"))
    nth = F.row_number().over(Window.partitionBy("token").orderBy("userid"))
    return users.withColumn("nth", nth).filter(F.col("nth") <= k + 1).drop("nth")


def _floors(sets: DataFrame, listed: DataFrame, k: int) -> tuple[DataFrame, DataFrame]:
    """(set, floor): campaigns that each neighbour shares at least; and (set, userid, m), users and how often they are listed for a set."""
    tokens = sets.select("set", F.explode("tokens").alias("token"))
    # a campaign's list has k + 1 rows, but very many sets may look at it
    met = lookup_join(tokens, listed.groupBy("token").agg(F.collect_list("userid").alias("users")), ["token"], "set")
    seen = materialize(met.select("set", F.explode("users").alias("userid")).groupBy("set", "userid").agg(F.count("*").alias("m")), "listed")
    nth = F.row_number().over(Window.partitionBy("set").orderBy(F.desc("m"), "userid"))
    top = seen.withColumn("nth", nth).filter(F.col("nth") <= k + 1).filter(F.col("nth") == k + 1).select("set", "m")
    # a set with k + 1 members fills itself
    own = F.when(F.size("ids") > k, F.col("size")).otherwise(1)
    floor = F.greatest(F.coalesce("m", F.lit(1)), own).cast("int").alias("floor")
    return materialize(sets.join(top, "set", "left").select("set", floor), "floors"), seen


def _ragged(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All values of a list column, and the row of each."""
    lists = column.combine_chunks()
    sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
    return lists.flatten().to_numpy(zero_copy_only=False), np.repeat(np.arange(len(lists)), sizes)


def common_counts(a: pa.ChunkedArray, b: pa.ChunkedArray) -> np.ndarray:
    """How many tokens each row of ``a`` has in common with each row of ``b``."""
    (at, ar), (bt, br) = _ragged(a), _ragged(b)
    shared = np.intersect1d(at, bt)
    # how often two rows have a token in common
    met = int(np.prod([np.bincount(np.searchsorted(shared, t[np.isin(t, shared)]), minlength=len(shared)) for t in (at, bt)], axis=0).sum())
    if met * PRODUCT_GAIN > len(a) * len(b) * len(shared) > 0:
        # small enough whole numbers, so that single precision is exact
        found = token_products(([(at, ar)], [(bt, br)]), ([(at[:0], ar[:0])], [(bt[:0], br[:0])]), len(a), len(b))
        return np.concatenate([sums for _, sums in found]).astype(np.int32)
    out = np.zeros((len(a), len(b)), np.int32)
    ao, bo = np.argsort(at, kind="stable"), np.argsort(bt, kind="stable")
    at, ar, bt, br = at[ao], ar[ao], bt[bo], br[bo]
    for token in np.intersect1d(at, bt):
        x = ar[np.searchsorted(at, token) : np.searchsorted(at, token, "right")]
        y = br[np.searchsorted(bt, token) : np.searchsorted(bt, token, "right")]
        out[np.ix_(x, y)] += 1
    return out


NEAR = pa.schema([("set", pa.int64()), ("other", pa.int64()), ("weight", pa.int64())])


def _nearest(a: pa.Table, b: pa.Table, k: int) -> pa.Table:
    """The k + 1 sets of ``b`` that share most with each of ``a``, two campaigns at least. Of equals the first in ``b`` go before."""
    own, other = a["set"].to_numpy(), b["set"].to_numpy()
    weight = common_counts(a["tokens"], b["tokens"]) if len(own) and len(other) else np.zeros((len(own), len(other)), np.int32)
    weight[own[:, None] == other] = 0
    if len(other) > k + 1:
        # no two of these numbers are equal, so exactly k + 1 are as large as the last of them; small ones are looked at faster
        kind = np.float32 if (int(weight.max(initial=0)) + 1) * len(other) < 1 << 24 else np.int64
        order = weight.astype(kind) * kind(len(other)) + np.arange(len(other), dtype=kind)[::-1]
        last = np.partition(order, len(other) - k - 1, axis=1)[:, len(other) - k - 1]
        best = np.flatnonzero(order >= last[:, None]).reshape(len(own), k + 1) % len(other)
    else:
        best = np.broadcast_to(np.arange(len(other)), weight.shape)
    found = np.take_along_axis(weight, best, axis=1)
    at, place = np.nonzero(found > 1)
    return pa.table([pa.array(own[at]), pa.array(other[best[at, place]]), pa.array(found[at, place].astype(np.int64))], schema=NEAR)


def _near_sets(sets: DataFrame, floors: DataFrame, k: int, asking: int, compared: int) -> DataFrame:
    """(set, other, weight): for each set the k + 1 others that share most, of those that share two and the set's floor at least."""
    n = sets.count()
    asking, compared = (max(least, math.ceil(n / MOST_GROUPS)) for least in (asking, compared))
    homes = max(1, math.ceil(n / asking))
    least = F.greatest(F.col("floor"), F.lit(2))
    # sets with the same rarest campaign ask together
    home = F.pmod(F.xxhash64(F.element_at("tokens", 1)), F.lit(homes)).cast("int")
    placed = sets.join(floors, "set").select("set", "tokens", "low", (F.col("size") - least + 1).alias("reach"), home.alias("home"))
    placed = materialize(placed.filter("reach > 0"), "asking")
    parts = placed.groupBy("home").agg(F.ceil(F.count("*") / asking).cast("int").alias("parts"))
    # a row for each home, of which there are n / asking: the table is that much smaller than the sets
    placed = lookup_join(placed, parts, ["home"], "set")
    queries = placed.select("set", "tokens", "low", "reach", F.struct("home", F.pmod(F.xxhash64("set"), "parts").cast("int").alias("part")).alias("cell"))
    queries = materialize(queries, "queries")
    wanted = queries.select("cell", F.explode(F.slice("tokens", F.lit(1), F.col("reach"))).alias("token")).distinct()
    lists = sets.select("set", F.explode("tokens").alias("token"))
    met = materialize(lookup_join(lists, wanted.groupBy("token").agg(F.collect_list("cell").alias("cells")), ["token"], "set")
        .select("set", F.explode("cells").alias("cell")).distinct(), "met")
    blocks = materialize(met.groupBy("cell").agg(F.ceil(F.count("*") / compared).cast("int").alias("blocks")), "blocks")
    block = F.pmod(F.xxhash64("set"), "blocks").cast("int").alias("block")
    right = met.join(blocks, "cell").select("cell", block, "set").join(sets.select("set", "tokens", "low"), "set")
    left = queries.join(blocks, "cell").select("cell", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), "set", "tokens")

    def nearest(a: pa.Table, b: pa.Table) -> pa.Table:
        b = b.sort_by("low")
        parts = [_nearest(a.slice(at, max(1, PAIRS // max(1, len(b)))), b, k) for at in range(0, len(a), max(1, PAIRS // max(1, len(b))))]
        return pa.concat_tables([NEAR.empty_table(), *parts])

    keys = ["cell", "block"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(nearest, "set long, other long, weight long")
    return materialize(found, "near_sets")


def similar_users_all(df: DataFrame, k: int = 5, asking: int = ASKING, compared: int = COMPARED) -> DataFrame:
    """The k users that share most campaigns with each user: user_id, neighbour, weight, rank. Ties go to the smaller id.

    Users that share no campaign with anybody have no row.
    """
    sets, members = _campaign_sets(df, k)
    listed = materialize(_listed_users(sets, k), "listed_users")
    floors, seen = _floors(sets, listed, k)
    near = _near_sets(sets, floors, k, asking, compared)
    ids = sets.select(F.col("set").alias("other"), "ids")
    found = [
        near.join(ids, "other").select("set", F.explode("ids").alias("neighbour"), "weight"),
        sets.select("set", F.explode("ids").alias("neighbour"), F.col("size").cast("long").alias("weight")),
        # one common campaign is all that a neighbour may have
        seen.join(floors.filter("floor = 1"), "set").select("set", F.col("userid").alias("neighbour"), F.lit(1).cast("long").alias("weight")),
    ]
    every = found[0].unionByName(found[1]).unionByName(found[2]).groupBy("set", "neighbour").agg(F.max("weight").alias("weight"))
    nth = F.row_number().over(Window.partitionBy("set").orderBy(F.desc("weight"), "neighbour"))
    # one more than asked for, as a user may be in the list of its own set
    top = every.withColumn("nth", nth).filter(F.col("nth") <= k + 1)
    top = top.groupBy("set").agg(F.array_sort(F.collect_list(F.struct("nth", "neighbour", "weight"))).alias("top"))
    each = lookup_join(members, materialize(top, "top"), ["set"], "userid")
    others = F.slice(F.filter("top", lambda t: t["neighbour"] != F.col("userid")), 1, k)
    rows = each.select(F.col("userid").alias("user_id"), F.posexplode(others).alias("at", "t"))
    return rows.select("user_id", "t.neighbour", "t.weight", (F.col("at") + 1).alias("rank"))
