"""Document fingerprints from closed syncmers with their places, in DataFrame functions only.

The units of a text are the characters of scripts that are written without spaces, and of all other runs without ASCII white space
the pieces of up to four characters from their beginning on. A k-mer is k units in a row; it is a closed syncmer when the smallest hash
among its inner s-mers lies at its first or last s-mer. Whether it is one depends on its own units alone, so the same passage gives
the same anchors wherever it stands, in the same order and at the same distances; k - s k-mers in a row hold at least one. A text without
any, which has few units, has one anchor of all its units; only a text without units has none. A null text counts as empty.

A fingerprint holds each anchor's hash (24 bits) and its distance from the anchor before, in units. Two fingerprints are matched by position:
of the places where their anchors agree the most frequent offset is taken, and anchors count as common when hash and place agree at that
offset. Likeness is twice the common ones by all, 1 when both have none; so a passage that was moved, or that is
repeated in one text, counts less than the same passage in place. Equal texts have equal fingerprints; rows may repeat; an empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..workdir import constant
from .rows import text_of

K, S = 9, 2
WHITE = r"\x20\x09-\x0D"
UNSPACED = r"\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}\p{IsTibetan}"
# A look-up of scripts is slow, and none of these has a character up to U+0E00: only those above are looked up.
ABOVE = r"\u0E01-\x{10FFFF}"
UNIT = rf"[\x21-\u0E00[\x00-\x08\x0E-\x1F[{ABOVE}&&[^{UNSPACED}]]]]{{1,4}}+|[{ABOVE}&&[{UNSPACED}]]"
HASH_BITS, PLACE_BITS = 24, 32


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is computed once, however often lambdas inside it use it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def run_of(values: Column, start: Column, n: int) -> list[Column]:
    """n neighbours in an array. (`slice` copies the whole array each time, so it would be quadratic here.)"""
    return [F.get(values, start + j) for j in range(n)]


def upto(n: Column) -> Column:
    """0 to n - 1."""
    return F.when(n > 0, F.sequence(F.lit(0), F.greatest(n, F.lit(1)) - 1)).otherwise(F.array().cast("array<int>"))


def units(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(UNIT), F.lit(0))


def low_bits(digest: Column) -> Column:
    return digest.bitwiseAND(F.lit((1 << HASH_BITS) - 1))


def packed(at: Column, digest: Column) -> Column:
    """An anchor as one number: its hash above its place."""
    return F.shiftleft(low_bits(digest), PLACE_BITS).bitwiseOR(at.cast("long"))


def place_of(anchor: Column) -> Column:
    return anchor.bitwiseAND(F.lit((1 << PLACE_BITS) - 1))


def syncmers(hashed: Column, k: int, s: int) -> Column:
    """The anchors of units, given by their hashes, in order."""
    width = k - s + 1

    def closed(m: Column, i: Column) -> Column:
        # Most k-mers are ruled out by the first comparisons, and the others are not made then.
        first, last = F.get(m, i), F.get(m, i + (width - 1))
        forward = backward = None
        for j in range(1, width):
            f, b = first <= F.get(m, i + j), last <= F.get(m, i + (width - 1 - j))
            forward, backward = (f, b) if forward is None else (forward & f, backward & b)
        return forward | backward

    def chosen(h: Column) -> Column:
        mers = F.transform(upto(F.size(h) - s + 1), lambda i: F.xxhash64(*run_of(h, i, s)))
        places = let(mers, lambda m: F.filter(upto(F.size(h) - k + 1), lambda i: closed(m, i)))
        return F.transform(places, lambda i: packed(i, F.xxhash64(*run_of(h, i, k))))

    return let(hashed, chosen)


def hashes_of(parts: Column) -> Column:
    return F.transform(parts, lambda u: F.xxhash64(u))


def or_whole(found: Column, parts: Column) -> Column:
    """The anchors, or one of all units where there are none."""
    whole = F.when(F.size(parts) > 0, F.array(packed(F.lit(0), F.xxhash64(parts)))).otherwise(F.array().cast("array<bigint>"))
    return let(found, lambda f: F.when(F.size(f) > 0, f).otherwise(whole))


def anchors(text: Column, k: int = K, s: int = S) -> Column:
    """The anchors of a text in order of their places."""
    return let(units(text), lambda u: or_whole(syncmers(hashes_of(u), k, s), u))


def edited_anchors(own: Column, prefix: Column, tail: Column, k: int = K, s: int = S) -> Column:
    """The anchors of `prefix` + `tail`, where `own` are those of a text that begins with `prefix`.

    Units that end before the last one of the prefix are the same in both texts, so only k-mers that reach beyond them are looked at.
    """
    trimmed = F.regexp_replace(prefix, f"[{WHITE}]+$", "")

    def joined(u: Column) -> Column:
        n = F.greatest(F.size(u) - 1, F.lit(0))  # units that stay as they are
        last = F.coalesce(F.get(u, F.size(u) - 1), F.lit(""))
        rest = F.concat(last, F.substring(prefix, F.length(trimmed) + 1, F.length(prefix)), tail)
        kept = F.least(n, F.lit(k - 1))

        def put(more: Column) -> Column:
            window = F.concat(F.slice(u, F.greatest(n - kept + 1, F.lit(1)), kept), more)
            found = F.transform(syncmers(hashes_of(window), k, s), lambda a: a + (n - kept).cast("long"))
            # A single anchor may be that of a whole text without syncmers.
            same = F.when(F.size(own) > 1, F.filter(own, lambda a: place_of(a) + k <= n)).otherwise(syncmers(hashes_of(F.slice(u, 1, n)), k, s))
            return or_whole(F.concat(same, found), F.concat(F.slice(u, 1, n), more))

        return let(units(rest), put)

    return let(units(prefix), joined)


def as_text(found: Column) -> Column:
    """Hash and distance of each anchor, base64 of four bytes each."""

    def spelled(a: Column, i: Column) -> Column:
        gap = place_of(a) - F.when(i > 0, place_of(F.get(found, i - 1))).otherwise(F.lit(0))
        return F.lpad(F.hex(F.shiftright(a, PLACE_BITS) * 256 + F.least(gap, F.lit(255))), 8, "0")

    return F.regexp_replace(F.base64(F.unhex(F.array_join(F.transform(found, spelled), ""))), "\r\n", "")


def offset_of(left: Column, right: Column) -> Column:
    """The most frequent difference of places between anchors of one hash, the smallest such; null where no hash is in both."""
    # Hash, side and place in one number each, so that a sort of numbers brings each hash's last place on the left before its first on the right.
    side = 1 << PLACE_BITS
    sided = lambda found, bit: F.transform(found, lambda a: a + F.shiftright(a, PLACE_BITS) * side + F.lit(bit))
    both = F.sort_array(F.concat(sided(left, 0), sided(right, side)))

    def differences(b: Column) -> Column:
        # Numbers of one hash and different sides differ by the side and their places.
        apart = lambda x, i: F.when(
            (F.shiftright(x, PLACE_BITS) == F.shiftright(F.get(b, i - 1), PLACE_BITS) + 1) & (F.shiftright(x, PLACE_BITS).bitwiseAND(F.lit(1)) == 1), x - F.get(b, i - 1) - F.lit(side)
        )
        return F.sort_array(F.array_compact(F.transform(b, apart)))

    state = F.struct(F.lit(None).cast("bigint").alias("last"), F.lit(0).alias("run"), F.lit(None).cast("bigint").alias("best"), F.lit(0).alias("most"))

    def count(acc: Column, x: Column) -> Column:
        run = F.when(acc["last"] == x, acc["run"] + 1).otherwise(F.lit(1))
        more = run > acc["most"]
        return F.struct(x.alias("last"), run.alias("run"), F.when(more, x).otherwise(acc["best"]).alias("best"), F.greatest(run, acc["most"]).alias("most"))

    return F.aggregate(let(both, differences), state, count, lambda acc: acc["best"])


def likeness(left: Column, right: Column) -> Column:
    """0 to 1: twice the anchors that agree in hash and place, at the offset on which most agree, by the anchors of both."""

    def at_offset(offset: Column) -> Column:
        moved = F.transform(right, lambda a: a - offset)
        return F.when(offset.isNull(), F.lit(0.0)).otherwise(2.0 * F.size(F.array_intersect(left, moved)))

    total = F.size(left) + F.size(right)
    return let(total, lambda n: F.when(n == 0, F.lit(1.0)).when(left == right, F.lit(1.0)).otherwise(let(offset_of(left, right), at_offset) / n))


def beside_next(docs: DataFrame, id_col: str, columns: list[str], tie: str, made: dict[str, Column], per_partition: int = 3) -> DataFrame:
    """Each row with `next_<column>` of the row that follows by id (null first, ties by `tie`); the first follows the last. The columns `made` are
    computed after the shuffle, once per row.

    Ids are numbers. Their quantiles cut the table into ranges, one shuffle brings each range together, and the row that begins a range goes
    to the range before as well, so that neighbours always meet. Ranges are looked up in a list of lists.
    """
    spark = docs.sparkSession
    n_ranges = per_partition * int(spark.conf.get("spark.sql.shuffle.partitions"))
    shares = [i / n_ranges for i in range(1, n_ranges)]
    found = docs.agg(
        F.percentile_approx(id_col, shares, max(10_000, 20 * n_ranges)).alias("cuts") if shares else F.array().alias("cuts"),
        F.min(id_col).alias("least"),
        F.count_if(F.col(id_col).isNull()).alias("nulls"),
    ).first()
    cuts = sorted({c for c in found["cuts"] or [] if c > found["least"] or found["nulls"]})
    group = max(1, math.isqrt(len(cuts)))
    lists = [cuts[i : i + group] for i in range(0, len(cuts), group)]
    kind = docs.schema[id_col].dataType.simpleString()
    own = F.col(id_col)
    before = constant([x[0] for x in lists], f"array<{kind}>")
    in_list = F.get(constant(lists, f"array<array<{kind}>>"), F.col("_fl_list") - 1)
    place = (F.col("_fl_list") - 1) * group + F.size(F.filter(in_list, lambda c: c <= own))
    begins = F.get(constant(cuts, f"array<{kind}>"), F.col("_fl_range") - 1) == own
    first = own.isNull() if found["nulls"] else own == F.lit(found["least"])
    home = lambda at, guest: F.struct(at.cast("int").alias("range"), F.lit(guest).alias("guest"))
    none = F.array().cast("array<struct<range:int,guest:int>>")
    homes = F.concat(
        F.array(home(F.col("_fl_range"), 0)),
        F.when(begins, F.array(home(F.col("_fl_range") - 1, 1))).otherwise(none),
        F.when(first, F.array(home(F.lit(len(cuts)), 1))).otherwise(none),
    )
    ranged = (
        docs.withColumn("_fl_list", F.when(own.isNull(), F.lit(0)).otherwise(F.size(F.filter(before, lambda c: c <= own))))
        .withColumn("_fl_range", F.when(F.col("_fl_list") == 0, F.lit(0)).otherwise(place))
        .withColumn("_fl_home", F.explode(homes))
        .select(*docs.columns, "_fl_home.range", "_fl_home.guest")
        .repartition("range")
        .withColumns(made)
    )
    following = Window.partitionBy("range").orderBy("guest", own.asc_nulls_first(), tie)
    return ranged.select("*", *[F.lead(c).over(following).alias(f"next_{c}") for c in [*columns, *made]]).where("guest = 0").drop("range", "guest")


def fingerprint_edits(docs: DataFrame, id_col: str = "doc_id", text: str = "text", k: int = K, s: int = S) -> DataFrame:
    """One row per document: id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text has its last quarter of code points, rounded down, replaced by as many first ones (or all) of the next document.
    Anchors are made once per text, where the range shuffle brought it; the edited text only needs those of its end.
    """
    base = docs.select(F.col(id_col), text_of(text).alias("text"))
    pairs = beside_next(base, id_col, ["text"], "text", {"own": anchors(F.col("text"), k, s)})
    rows = pairs.select(
        id_col,
        F.length("text").cast("long").alias("n_chars"),
        "own",
        "next_own",
        F.expr("substring(text, 1, length(text) - length(text) div 4)").alias("prefix"),
        F.expr("substring(next_text, 1, cast(length(text) div 4 as int))").alias("tail"),
    ).withColumn("changed", edited_anchors(F.col("own"), F.col("prefix"), F.col("tail"), k, s))
    return rows.select(
        id_col,
        "n_chars",
        F.sha2(F.concat("prefix", "tail"), 256).alias("edited_sha256"),
        as_text(F.col("own")).alias("fingerprint"),
        as_text(F.col("changed")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("changed")).alias("near_edited"),
        likeness(F.col("own"), F.col("next_own")).alias("near_next"),
    )
