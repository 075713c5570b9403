"""Labels that need order lines: products, brands, coupons, discounts."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from patronlens.functions import rules
from patronlens.functions.labels import band, classify_like, first_match, ratio
from patronlens.operators.lineage import settle
from patronlens.operators.orders import completed
from patronlens.operators.sequence import place, place_small, split_by_size, with_stretch
from patronlens.operators.skew import split_join
from patronlens.operators.topk import top_k_per_group

LIST_PART = 10_000  # entries per row of a list column; longer lists go on in further rows


def purchased_lines(orders: DataFrame, goods: DataFrame, *order_columns: str, lines: DataFrame | None = None) -> DataFrame:
    """Order lines with columns of their order. Filter ``orders`` first where possible.

    An order with very many lines is split over tasks. Such orders are looked for in ``lines``,
    if given: the lines in a form that is cheaper to read, as before they are joined to their products.
    """
    kept = orders.select("orderSn", "memberId", *order_columns)
    return split_join(goods, kept, "cOrderSn", "orderSn", lines).drop("orderSn", "cOrderSn")


def _by_member(rows: DataFrame, small: Callable[[DataFrame], DataFrame], large: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """``small`` of the members that one task may hold, whose rows are shuffled once for all its steps, and ``large`` of the others.

    ``rows`` are settled ones.
    """
    few, many = split_by_size(rows, "memberId")
    done = small(few.repartition("memberId"))
    return done if many is None else done.unionByName((large or small)(many))


def _per_order(orders: DataFrame, goods: DataFrame, sums: Sequence[Column], how: str = "inner") -> DataFrame:
    """Orders with sums over their lines, or over ``goods`` that are such sums already (they have ``_lines``).

    The lines shrink to one row per order before they are shuffled, and the join uses
    the partitioning of that aggregation. So it costs no shuffle of its own, and an
    order with very many lines is no hot key.
    """
    summed = goods if "_lines" in goods.columns else goods.groupBy("cOrderSn").agg(*sums)
    return orders.join(summed, F.col("orderSn") == F.col("cOrderSn"), how).drop("cOrderSn")


def _one_row_per_member(ranked: DataFrame, names: dict[tuple[str, int], str]) -> DataFrame:
    """Ranked (memberId, kind, value, rank) rows as one row with a column per (kind, rank)."""
    picks = [
        F.max(F.when((F.col("kind") == kind) & (F.col("rank") == rank), F.col("value"))).alias(name)
        for (kind, rank), name in names.items()
    ]
    ranks = F.max(F.when(F.col("kind") == "product", F.col("rank"))).alias("_depth")
    return ranked.groupBy("memberId").agg(*picks, ranks)


def product_preference(orders: DataFrame, goods: DataFrame, k: int = 3) -> DataFrame:
    """Favourite product type and the ``k`` products bought most, by number of lines.

    Types and products are counted in one pass over the join. Members with fewer
    than ``k`` products are left out.
    """
    return _preferred(purchased_lines(completed(orders), goods).withColumn("n", F.lit(1).cast("bigint")), k)


def _preferred(lines: DataFrame, k: int) -> DataFrame:
    """``product_preference`` of (memberId, productType, productName, n) rows that stand for ``n`` lines each."""
    kinds = F.array(
        F.struct(F.lit("type").alias("kind"), F.col("productType").alias("value")),
        F.struct(F.lit("product").alias("kind"), F.col("productName").alias("value")),
    )
    counted = (
        lines.select("memberId", "n", F.explode(kinds).alias("k"))
        .select("memberId", "k.kind", "k.value", "n")
        .groupBy("memberId", "kind", "value")
        .agg(F.sum(F.when(F.col("value").isNotNull(), F.col("n")).otherwise(0)).alias("n"))
    )
    ranked = top_k_per_group(counted, ["memberId", "kind"], "value", k)
    names = {("type", 1): "productType"}
    names |= {("product", i): f"productName{i}" for i in range(1, k + 1)}
    return _one_row_per_member(ranked, names).filter(F.col("_depth") == k).drop("_depth")


def _weekly_counts(orders: DataFrame, goods: DataFrame, with_year: bool) -> tuple[DataFrame, list[str]]:
    done = completed(orders).withColumn("cycle", F.weekofyear("modified"))
    keys = ["memberId", "cycle"]
    if with_year:
        done = done.withColumn("year", F.extract(F.lit("YEAROFWEEK"), F.col("modified")))
        keys.insert(1, "year")
    lines = purchased_lines(done, goods, *keys[1:])
    return lines.groupBy(*keys, "productName").agg(F.count(F.lit(1)).alias("n")), keys


def _week_total(total: Column) -> Column:
    return F.when(F.col("cycle").isNotNull(), total).otherwise(0)


def weekly_basket(
    orders: DataFrame,
    goods: DataFrame,
    users: DataFrame,
    with_year: bool = False,
    part_size: int = LIST_PART,
) -> DataFrame:
    """Products bought per member and ISO week, with the contact data of the member.

    ``products`` is an array in name order, equal names repeated. A list of more than
    ``part_size`` entries goes on in rows with a higher ``part``; ``count`` is the
    number of lines of the whole week. Equal weeks of different years are one week
    unless ``with_year`` is set.
    """
    counted, keys = _weekly_counts(orders, goods, with_year)
    counted = settle(counted)
    few, many = split_by_size(counted, *keys)
    placed = place_small(few, keys, ["productName"], F.col("n"))
    if many is not None:
        stretched = place(with_stretch(many, keys, "productName"), keys, ["productName"], F.col("_stretch"), F.col("n"))
        placed = placed.unionByName(stretched.drop("_stretch", "following"))
    end = F.col("start") + F.col("n")
    last = F.floor((end - 1) / part_size)
    pieces = placed.select(
        *keys, "productName", "start", "total", end.alias("end"),
        F.explode(F.sequence(F.floor(F.col("start") / part_size), last)).alias("part"),
    )
    copies = F.least("end", (F.col("part") + 1) * part_size) - F.greatest("start", F.col("part") * part_size)
    listed = (
        pieces.withColumn("copies", copies.cast("int"))
        .groupBy(*keys, "part", "total")
        .agg(F.sort_array(F.collect_list(F.struct("productName", "copies"))).alias("entries"))
    )
    repeated = F.flatten(
        F.transform("entries", lambda e: F.array_repeat(e["productName"], e["copies"]))
    )
    baskets = listed.select(
        *keys, "part", F.array_compact(repeated).alias("products"), _week_total(F.col("total")).alias("count")
    )
    contacts = users.select("id", "email", "mobile")
    return baskets.join(contacts, F.col("memberId") == F.col("id")).select(
        "id", *keys[1:], "part", "products", "count", "email", "mobile"
    )


def basket_preview(
    orders: DataFrame, goods: DataFrame, users: DataFrame, items: int = rules.PREVIEW_ITEMS
) -> DataFrame:
    """Per member and week: number of lines and the first products, with a mark when more follow.

    Only the first ``items`` names of a week are ever gathered.
    """
    counted, _ = _weekly_counts(orders, goods, False)
    return _known_previews(_previews(settle(counted), items), users)


def _known_previews(previews: DataFrame, users: DataFrame) -> DataFrame:
    known = users.select("id")
    return previews.join(known, F.col("memberId") == F.col("id")).select("id", "cycle", "count", "preview")


def _shown(items: int) -> Column:
    """First products of a week from its ``head`` of (productName, n) and ``_named``, the number of its lines that have a name."""
    shown = F.slice(F.flatten(F.transform("head", lambda e: F.array_repeat(e["productName"], e["n"]))), 1, items)
    return F.concat(F.array_join(shown, ","), F.when(F.col("_named") > items, rules.PREVIEW_MORE).otherwise(""))


def _previews(counted: DataFrame, items: int) -> DataFrame:
    """(memberId, cycle, count, preview) from (memberId, cycle, productName, n); of a week only the first names are gathered."""
    keys = ["memberId", "cycle"]
    week = F.struct(*keys).alias("_week")  # null-safe as one key
    named = F.col("productName").isNotNull()
    by_name = top_k_per_group(
        counted.filter(named).withColumn("_same", F.lit(0)), keys, "productName", items, score="_same"
    )
    heads = by_name.groupBy(week).agg(
        F.sort_array(
            F.collect_list(F.struct("productName", F.least("n", F.lit(items)).cast("int").alias("n")))
        ).alias("head")
    )
    totals = counted.groupBy(week).agg(
        F.sum("n").alias("count"), F.sum(F.when(named, F.col("n")).otherwise(0)).alias("_named")
    )
    return totals.join(heads, "_week", "left").select(
        "_week.*", "count", _shown(items).alias("preview")
    ).withColumn("count", _week_total(F.col("count")))


def _previews_small(counted: DataFrame, items: int) -> DataFrame:
    """The same for weeks that one task may hold: one window and one aggregation, no join."""
    keys = ["memberId", "cycle"]
    named = F.col("productName").isNotNull()
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(F.asc_nulls_last("productName")))
    first = F.struct("productName", F.least("n", F.lit(items)).cast("int").alias("n"))
    weeks = counted.withColumn("_rank", rank).groupBy(*keys).agg(
        F.sum("n").alias("count"),
        F.sum(F.when(named, F.col("n")).otherwise(0)).alias("_named"),
        F.sort_array(F.collect_list(F.when(named & (F.col("_rank") <= items), first))).alias("_head"),
    )
    weeks = weeks.withColumn("head", F.when(F.size("_head") > 0, F.col("_head")))
    return weeks.select(*keys, _week_total(F.col("count")).alias("count"), _shown(items).alias("preview"))


def preview_and_preference(
    orders: DataFrame, goods: DataFrame, users: DataFrame, items: int = rules.PREVIEW_ITEMS, k: int = 3, lines: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """``basket_preview`` and ``product_preference`` of the same lines, which are joined and counted once.

    The counts per member, week, type and product are written; a member's counts are shuffled once
    for both, unless they are too many for one task. ``lines`` as in ``purchased_lines``.
    """
    done = completed(orders).where("memberId IS NOT NULL").withColumn("cycle", F.weekofyear("modified"))
    counted = settle(
        purchased_lines(done, goods, "cycle", lines=lines)
        .groupBy("memberId", "cycle", "productType", "productName").agg(F.count(F.lit(1)).alias("n"))
    )
    weekly = lambda rows: rows.groupBy("memberId", "cycle", "productName").agg(F.sum("n").alias("n"))
    previews = _by_member(counted, lambda rows: _previews_small(weekly(rows), items), lambda rows: _previews(settle(weekly(rows)), items))
    return _known_previews(previews, users), _by_member(counted, lambda rows: _preferred(rows, k))


def coupon_sums(columns: Sequence[str]) -> list[Column]:
    """What ``coupon_scores`` needs of the lines of an order: their number, and how many have each of ``columns``."""
    used = lambda c: F.count_if(F.col(c).cast("double") != 0).alias(c)
    return [F.count(F.lit(1)).alias("_lines"), *[used(c) for c in columns]]


def coupon_scores(
    orders: DataFrame,
    goods: DataFrame,
    coupon=rules.COUPON_SCORE,
    card=rules.CARD_SCORE,
    activity=rules.ACTIVITY_SCORE,
) -> DataFrame:
    """Scores for completed lines bought with a coupon, a gift card or at an activity price.

    Every member has a row. A gift card kept on the order counts once per line, as
    joined rows would. ``goods`` may be lines, or their ``coupon_sums`` by cOrderSn.
    """
    on_line = "giftCardAmount" in goods.columns
    flags = ["couponAmount", "activityPrice"] + (["giftCardAmount"] if on_line else [])
    card_column = [] if on_line else [F.col("giftCardAmount").alias("_card")]
    joined = _per_order(
        orders.select("orderSn", "memberId", "orderStatus", *card_column),
        goods.select("cOrderSn", *(c for c in ["_lines", *flags] if c in goods.columns)),
        coupon_sums(flags),
        "left",
    )
    cards = (
        F.col("giftCardAmount")
        if on_line
        else F.when(F.col("_card").cast("double") != 0, F.coalesce(F.col("_lines"), F.lit(1)))
    )
    done = F.col("orderStatus") == rules.COMPLETED
    count = lambda c: F.coalesce(F.sum(F.when(done, c)), F.lit(0))
    counts = joined.groupBy("memberId").agg(
        count(F.col("couponAmount")).alias("coupons"),
        count(cards).alias("cards"),
        count(F.col("activityPrice")).alias("activities"),
    )
    return counts.select(
        "memberId",
        band("coupons", coupon).alias("buy_coupon"),
        band("cards", card).alias("buy_card"),
        band("activities", activity).alias("buy_activity"),
    )


def _discount_sums() -> list[Column]:
    """Partial sums over rows with a paid-to-list ratio ``_rate``; they add up to any level."""
    return [
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("_rate") < 1).alias("cheaper"),
        F.sum("_rate").alias("rates"),
        F.count("_rate").alias("rated"),
    ]


def discount_scores(
    orders: DataFrame,
    goods: DataFrame | None = None,
    bought=rules.BUY_SCORE,
    discounted=rules.DISCOUNT_COUNT_SCORE,
    depth=rules.DISCOUNT_RATIO_SCORE,
) -> DataFrame:
    """Scores for number of purchases, discounted purchases and mean paid-to-list ratio.

    Purchases are completed orders with orderAmount and productAmount, or, with
    ``goods``, their lines with productAmount and the discount share couponAmount. The
    mean is rounded far below the cuts, so it does not depend on the order in which
    partial sums arrive.
    """
    if goods is None:
        rated = completed(orders).withColumn("_rate", ratio("orderAmount", "productAmount"))
        counts = rated.groupBy("memberId").agg(*_discount_sums())
    else:
        listed = F.col("productAmount").cast("double")
        paid = listed * (1 - F.col("couponAmount").cast("double"))
        lines = goods.select("cOrderSn", ratio(paid, listed).alias("_rate"))
        kept = completed(orders).select("orderSn", "memberId")
        summed = _per_order(kept, lines, _discount_sums())
        counts = summed.groupBy("memberId").agg(
            *[F.sum(c).alias(c) for c in ("n", "cheaper", "rates", "rated")]
        )
    return counts.select(
        "memberId",
        band("n", bought).alias("colbuy"),
        band("cheaper", discounted).alias("coldis"),
        band(F.round(ratio("rates", "rated"), 9), depth).alias("colavgdis"),
    )


def brand_class(patterns: Sequence[tuple[str, str]], otherwise: str) -> Column:
    return classify_like("productName", patterns, otherwise)


def _brand_weight(brand: Column, house: str, otherwise: str, none: int) -> Column:
    cases = [(brand == otherwise, none), (brand == house, rules.HOUSE_BRAND_WEIGHT)]
    return first_match(cases, rules.SUB_BRAND_WEIGHT)


def _member_counts(orders: DataFrame, goods: DataFrame, kind: Column, names: dict[str, object]) -> DataFrame:
    """Lines per member of each kind, one column per entry of ``names`` (column to kind)."""
    lines = goods.select("cOrderSn", kind.alias("_kind"))
    counted = [F.count_if(F.col("_kind") == value).alias(name) for name, value in names.items()]
    joined = _per_order(orders.select("orderSn", "memberId"), lines, counted)
    return joined.groupBy("memberId").agg(*[F.sum(name).alias(name) for name in names])


def brand_preference(
    orders: DataFrame,
    goods: DataFrame,
    brands: Sequence[tuple[str, str]] = rules.BRANDS,
    house: str = rules.HOUSE_BRAND,
    otherwise: str = rules.BRAND_NONE,
    none_weight: int = rules.NO_BRAND_WEIGHT,
) -> DataFrame:
    """Brand with the highest weighted number of completed lines per member.

    The brands are few and known, so each is one conditional count per order, summed
    per member, and the best is picked inside the row. Equal scores: lower name.
    """
    labels = sorted([label for _, label in brands] + [otherwise])
    names = {f"_n{i}": label for i, label in enumerate(labels)}
    counts = _member_counts(completed(orders), goods, brand_class(brands, otherwise), names)

    def entry(i: int, label: str) -> Column:
        n = F.col(f"_n{i}")
        score = n * _brand_weight(F.lit(label), house, otherwise, none_weight)
        found = F.struct(score.alias("score"), F.lit(-i).alias("tie"), F.lit(label).alias("brand"))
        return F.when(n > 0, found)

    best = F.array_max(F.array(*[entry(i, label) for i, label in enumerate(labels)]))
    return counts.select("memberId", best["brand"].alias("brand"))


def brand_ratings(
    users: DataFrame,
    orders: DataFrame,
    goods: DataFrame,
    codes: Sequence[tuple[str, int]] = rules.BRAND_CODES,
) -> DataFrame:
    """Lines per user and brand code, all orders; lines of no known brand are left out."""
    names = {f"_n{code}": code for _, code in codes}
    counts = _member_counts(orders, goods, classify_like("productName", codes), names)
    entries = F.array(
        *[F.struct(F.lit(code).alias("brand"), F.col(name).alias("rating")) for name, code in names.items()]
    )
    known = users.select(F.col("id").alias("user_id"))
    return (
        known.join(counts, F.col("user_id") == F.col("memberId"))
        .select("user_id", F.inline(entries))
        .filter(F.col("rating") > 0)
    )


def purchase_history(
    orders: DataFrame,
    goods: DataFrame,
    brands: Sequence[tuple[str, str]] = rules.BRANDS,
    house: str = rules.HOUSE_BRAND,
    otherwise: str = rules.BRAND_ELSE,
    part_size: int = LIST_PART,
    lines: DataFrame | None = None,
    products: DataFrame | None = None,
) -> DataFrame:
    """Per member: products seen in any order, products bought of the favourite type, favourites.

    ``product_scan`` and ``product_buy`` are arrays in name order. Members with more
    than ``part_size`` products have further rows with a higher ``part``. Members
    without a completed order are left out. ``lines`` as in ``purchased_lines``.

    The lines are counted per member, type and product, and written. A member's counts are then
    shuffled once for all that follows; only members too large for one task are
    sorted in stretches. With ``products`` (productId, productType, productName), ``goods`` name their product
    by ``productId`` only: the counts meet types and names when the lines have been shuffled and counted without them.
    """
    done = F.col("orderStatus") == rules.COMPLETED
    product = ["productType", "productName"] if products is None else ["productId"]
    counts = (
        purchased_lines(orders.where("memberId IS NOT NULL"), goods, "orderStatus", lines=lines)
        .groupBy("memberId", *product)
        .agg(F.count_if(done).alias("bought"))
    )
    if products is not None:
        # Products that share type and name give several rows, which all that follows adds up.
        counts = counts.join(products, "productId").select("memberId", "productType", "productName", "bought")
    owned = settle(counts)

    def in_stretches(rows: DataFrame) -> DataFrame:
        return place(with_stretch(rows, ["memberId"], "productName"), ["memberId"], ["productName"], F.col("_stretch"))

    return _by_member(
        owned,
        lambda rows: _histories(rows, lambda r: r, lambda r: place_small(r, ["memberId"], ["productName"]), brands, house, otherwise, part_size),
        lambda rows: _histories(rows, settle, in_stretches, brands, house, otherwise, part_size),
    )


def _histories(
    owned: DataFrame,
    kept: Callable[[DataFrame], DataFrame],
    placed_by: Callable[[DataFrame], DataFrame],
    brands: Sequence[tuple[str, str]],
    house: str,
    otherwise: str,
    part_size: int,
) -> DataFrame:
    """Histories from (memberId, productType, productName, bought); ``kept`` keeps the favourites, ``placed_by`` numbers products."""
    brand = brand_class(brands, otherwise)
    weight = _brand_weight(brand, house, otherwise, rules.HISTORY_NO_BRAND_WEIGHT)
    entry = lambda kind, value, n: F.struct(
        F.lit(kind).alias("kind"), value.alias("value"), n.alias("n")
    )
    bought = F.col("bought")
    kinds = F.array(
        entry("type", F.col("productType"), bought),
        entry("product", F.col("productName"), bought),
        entry("brand", brand, bought * weight),
    )
    counted = (
        owned.filter(bought > 0)
        .select("memberId", F.explode(kinds).alias("k"))
        .select("memberId", "k.*")
        .groupBy("memberId", "kind", "value")
        .agg(F.sum("n").alias("n"))
    )
    ranked = top_k_per_group(counted, ["memberId", "kind"], "value", 1)
    favourites = _one_row_per_member(
        ranked, {("type", 1): "_type", ("product", 1): "_product", ("brand", 1): "_brand"}
    ).select("memberId", "_type", "_product", "_brand")

    products = (
        owned.filter(F.col("productName").isNotNull())
        .join(kept(favourites), "memberId")
        .groupBy("memberId", "productName", "_type", "_product", "_brand")
        .agg(F.max((bought > 0) & (F.col("productType") == F.col("_type"))).alias("chosen"))
    )
    listed = (
        placed_by(products).withColumn("part", F.floor(F.col("start") / part_size))
        .groupBy("memberId", "part", "_type", "_product", "_brand")
        .agg(F.sort_array(F.collect_list(F.struct("productName", "chosen"))).alias("entries"))
    )
    names = lambda entries: F.transform(entries, lambda e: e["productName"])
    return listed.select(
        "memberId",
        "part",
        names(F.col("entries")).alias("product_scan"),
        names(F.filter("entries", lambda e: e["chosen"])).alias("product_buy"),
        F.col("_type").alias("productType"),
        F.col("_product").alias("productName"),
        F.col("_brand").alias("brand"),
    )
