"""Which devices of a store have costs that go up and down together, or against each other.

Every device has a cost series over fixed buckets of time, with 0 where it had none. Standardised, a series is a unit vector,
and the correlation of two devices is the product of theirs. An index finds the pairs: the signs of random projections
of a vector, cut into bands; series that correlate agree in all signs of some band. What agrees is checked exactly. A band
has as many signs as keep chance agreements in the largest store few, and there are as many bands as make a pair at the limit
missed with a small probability only. A series and its mirror image share their codes, so opposite devices meet as well.

Signs are cheap where partners are few and close. In a store of many devices at a low limit a band is so short and bands are so many
that their codes cost more than the products themselves; there the devices of a store are multiplied with each other, dealt over many
tasks, and a pair leaves its task only as a count, a maximum and a minimum of its device. No pair is missed then.

The result has one row per device, however many it goes with.
"""

from __future__ import annotations

import datetime as dt
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costalloc.functions.timeparts import moment
from costalloc.operators.cleanse import between
from costalloc.operators.skew import salted_join
from costalloc.session import materialize

LIMIT = 0.7
MISSED = 1e-6  # chance that a pair exactly at the limit is in no band together; less for closer pairs
CHANCE_MATES = 4  # unrelated devices that a band may bring together
DEVICE = ["StoreNumber", "DeviceId"]
PLACES = 1_000_000_000  # correlations are compared as whole billionths, which take 30 bits
NUMBERS = 1 << 32  # devices that can be numbered
PLAIN_BUCKETS = 64  # up to so many numbers of a series are columns of their own


def cost_vectors(fact: DataFrame, start: dt.datetime, end: dt.datetime, bucket_hours: int) -> DataFrame:
    """(StoreNumber, DeviceId, Cost, z): the standardised series of each device over the buckets of a half-open span.

    Devices whose cost is the same in all buckets have no correlation and no z. A series has as many numbers as the span
    has buckets, whatever the data.
    """
    width = bucket_hours * 3_600_000_000
    n = math.ceil((end - start) / dt.timedelta(hours=bucket_hours))
    place = F.floor((F.unix_micros("TimeWindow") - F.unix_micros(moment(start))) / F.lit(width)).cast("int")
    cells = between(fact, "TimeWindow", start, end).groupBy(*DEVICE, place.alias("place")).agg(F.sum("AllocatedCost").alias("cost"))
    devices = cells.groupBy(*DEVICE).agg(
        F.map_from_entries(F.collect_list(F.struct("place", "cost"))).alias("m"), F.sum("cost").alias("Cost")
    )
    # rounded, so that the noise of a sum does not make an unchanging series look as if it varied
    at = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.round(F.coalesce(F.element_at("m", i), F.lit(0.0)), 9))
    devices = devices.withColumn("x", at)
    total = lambda c: F.aggregate(c, F.lit(0.0), lambda a, v: a + v)
    devices = devices.withColumn("mean", total("x") / n).withColumn("d", F.transform("x", lambda v: v - F.col("mean")))
    norm = F.sqrt(total(F.transform("d", lambda v: v * v)))
    varies = F.array_min("x") < F.array_max("x")
    devices = devices.withColumn("norm", norm)
    z = F.when(varies & (F.col("norm") > 0), F.transform("d", lambda v: v / F.col("norm")))
    return devices.select(*DEVICE, "Cost", z.alias("z"))


def bands_for(n_devices: int, limit: float = LIMIT, missed: float = MISSED) -> tuple[int, int]:
    """(bands, signs per band) for the devices of a store."""
    signs = max(2, min(30, math.ceil(math.log2(max(2, n_devices) / CHANCE_MATES))))
    agree = (1 - math.acos(limit) / math.pi) ** signs
    return max(1, math.ceil(math.log(missed) / math.log(1 - agree))), signs


def band_codes(z: Column | str, bands: int, signs: int) -> Column:
    """One code per band: the signs of projections on random vectors of +1 and -1, the same for a series and its mirror image."""

    def sign(band: Column, k: Column) -> Column:
        along = F.transform(z, lambda v, i: F.when(F.xxhash64(band, k, i) >= 0, v).otherwise(-v))
        return F.when(F.aggregate(along, F.lit(0.0), lambda a, v: a + v) >= 0, 1).otherwise(0)

    def code(band: Column) -> Column:
        bits = F.aggregate(F.sequence(F.lit(0), F.lit(signs - 1)), F.lit(0).cast("bigint"), lambda a, k: a * 2 + sign(band, k))
        return F.least(bits, F.lit((1 << signs) - 1) - bits)

    return F.transform(F.sequence(F.lit(0), F.lit(bands - 1)), code)


def correlated_pairs(vectors: DataFrame, limit: float = LIMIT, missed: float = MISSED) -> DataFrame:
    """(StoreNumber, a, b, Correlation) of all pairs that share a band and are over the limit, a < b.

    An intermediate of the index: pairs are as many as there are, so callers reduce them to a row per device.
    """
    known = vectors.where("z IS NOT NULL").select(*DEVICE, "z")
    largest = known.groupBy("StoreNumber").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
    bands, signs = bands_for(largest, limit, missed)
    coded = known.select(*DEVICE, F.posexplode(band_codes("z", bands, signs)).alias("band", "code"))
    left = coded.withColumnRenamed("DeviceId", "a")
    right = coded.withColumnRenamed("DeviceId", "b")
    met = left.join(right, ["StoreNumber", "band", "code"]).where("a < b").select("StoreNumber", "a", "b").distinct()
    za = known.select("StoreNumber", F.col("DeviceId").alias("a"), F.col("z").alias("za"))
    zb = known.select("StoreNumber", F.col("DeviceId").alias("b"), F.col("z").alias("zb"))
    both = met.join(za, ["StoreNumber", "a"]).join(zb, ["StoreNumber", "b"])
    r = F.round(F.aggregate(F.zip_with("za", "zb", lambda x, y: x * y), F.lit(0.0), lambda t, v: t + v), 9)
    return both.select("StoreNumber", "a", "b", r.alias("Correlation")).where(F.abs("Correlation") > limit)


def _numbered(known: DataFrame) -> DataFrame:
    """Devices with a `number` that grows with the name: by ranges of names, counted, so that no task has them all."""
    order = ["DeviceId", "StoreNumber"]
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    ranged = known.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = materialize(ranged.withColumns({"part": F.spark_partition_id(), "place": place}), "numbered")
    first, before = [], 0
    for part, n in sorted(tuple(r) for r in rows.groupBy("part").count().collect()):
        first += [F.lit(part), F.lit(before)]
        before += n
    if before >= NUMBERS:
        raise ValueError(f"{before} devices are too many to be numbered")
    start = F.create_map(*first)[F.col("part")] if first else F.lit(0)
    return rows.select(*DEVICE, "z", (start + F.col("place")).cast("bigint").alias("number"))


def _least_over(limit: float) -> int:
    """The greatest number of billionths that is not over the limit."""
    most = int(limit * PLACES)
    while most / PLACES > limit:
        most -= 1
    while (most + 1) / PLACES <= limit:
        most += 1
    return most


def _closest_of_all(known: DataFrame, buckets: int, limit: float) -> DataFrame:
    """(StoreNumber, DeviceId, c, Links, least) by the products of all devices of a store.

    The devices of a store are dealt over tasks, and each task has all of its store to multiply them with. Of several partners
    alike the smallest name counts, so a whole number holds size, name and sign, which the task keeps a maximum of.
    """
    rows = _numbered(known)

    def side(number: str, name: str) -> DataFrame:
        if buckets > PLAIN_BUCKETS:
            return rows.select("StoreNumber", F.col("number").alias(number), F.col("z").alias(name))
        return rows.select("StoreNumber", F.col("number").alias(number), *[F.col("z")[k].alias(f"{name}{k}") for k in range(buckets)])

    if buckets > PLAIN_BUCKETS:
        along = F.aggregate(F.zip_with("x", "y", lambda x, y: x * y), F.lit(0.0), lambda t, v: t + v)
    else:
        along = F.lit(0.0)
        for k in range(buckets):
            along = along + F.col(f"x{k}") * F.col(f"y{k}")
    r = F.rint(along * PLACES).cast("bigint")
    # few bytes are many products: dealt by bytes of its files, one side would be few tasks where the other one is broadcast
    met = salted_join(side("a", "x").repartition("a"), side("b", "y"), ["StoreNumber"], ["a"])
    found = met.where((F.col("a") != F.col("b")) & (F.abs(r) > _least_over(limit))).select("a", "b", r.alias("r"))
    rank = F.shiftleft(F.abs("r"), 33) + F.shiftleft(F.lit(NUMBERS - 1) - F.col("b"), 1) + (F.col("r") > 0).cast("bigint")
    devices = found.groupBy("a").agg(F.max(rank).alias("best"), F.count("*").alias("Links"), F.min("b").alias("l"))
    size = F.shiftright("best", 33) / F.lit(PLACES)
    partner = F.lit(NUMBERS - 1) - F.shiftright("best", 1).bitwiseAND(F.lit(NUMBERS - 1))
    told = devices.select("a", "Links", "l", partner.alias("p"), F.when(F.col("best") % 2 == 1, size).otherwise(-size).alias("Correlation"))
    names = rows.select("number", "DeviceId")
    told = told.join(rows.select(*DEVICE, F.col("number").alias("a")), "a")
    told = told.join(names.toDF("p", "other"), "p").join(names.toDF("l", "least"), "l")
    return told.select(*DEVICE, F.struct("other", "Correlation").alias("c"), "Links", "least")


def _closest_by_bands(vectors: DataFrame, limit: float, missed: float) -> DataFrame:
    """The same by the pairs that share a band."""
    pairs = correlated_pairs(vectors, limit, missed)
    each = pairs.select("StoreNumber", F.inline(F.array(
        F.struct(F.col("a").alias("DeviceId"), F.col("b").alias("other"), "Correlation"),
        F.struct(F.col("b").alias("DeviceId"), F.col("a").alias("other"), "Correlation"),
    )))
    closest = F.min(F.struct((-F.abs("Correlation")).alias("far"), "other", "Correlation"))
    return each.groupBy(*DEVICE).agg(closest.alias("c"), F.count("*").alias("Links"), F.min("other").alias("least"))


def bands_pay(n_devices: int, limit: float = LIMIT, missed: float = MISSED) -> bool:
    """Whether the codes of a device take fewer products than all other devices of its store."""
    bands, signs = bands_for(n_devices, limit, missed)
    return bands * signs < n_devices


def device_correlation_index(
    fact: DataFrame, start: dt.datetime, end: dt.datetime, bucket_hours: int = 24, limit: float = LIMIT, missed: float = MISSED
) -> DataFrame:
    """One row per device that goes with another one of its store, with its closest partner and how many it has.

    Partner: the one of the greatest absolute correlation, of several the smallest name. Group: the smallest name among
    the device and its partners, which stands for them. With the cost figures of the store, over all its devices.
    """
    vectors = materialize(cost_vectors(fact, start, end, bucket_hours), "series")
    known = vectors.where("z IS NOT NULL AND StoreNumber IS NOT NULL AND DeviceId IS NOT NULL").select(*DEVICE, "z")
    sizes = known.groupBy("StoreNumber").agg(F.count("*").alias("n"), F.max(F.size("z")).alias("k"))
    largest, buckets = sizes.agg(F.coalesce(F.max("n"), F.lit(0)), F.coalesce(F.max("k"), F.lit(1))).first()
    by_bands = bands_pay(largest, limit, missed)
    devices = _closest_by_bands(vectors, limit, missed) if by_bands else _closest_of_all(known, buckets, limit)
    stores = vectors.groupBy("StoreNumber").agg(
        F.count("*").alias("device_count"), F.sum("Cost").alias("total_store_cost"), F.avg("Cost").alias("avg_device_cost")
    )
    return devices.join(stores, "StoreNumber").select(
        *DEVICE,
        F.col("c.other").alias("Partner"),
        F.col("c.Correlation").alias("Correlation"),
        F.when(F.col("c.Correlation") > 0, "positive").otherwise("negative").alias("Relationship"),
        "Links",
        F.least("DeviceId", "least").alias("Group"),
        "device_count",
        "total_store_cost",
        "avg_device_cost",
    )
