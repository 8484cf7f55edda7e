"""Cart contents as rows (K04, E12, X-cl10, X-cl11, X-cl12, X-cl15).

A cart is a multiset, kept as rows (event, product, n) and never as a list per
customer.  Each add or remove gives its product a new running count that holds
until the product's next change or the end of the cart; these stretches become
rows of the events they cover.  Two neighbouring carts are compared by their
change set: the later cart's rows with plus, the earlier one's with minus, and
the sums that aren't zero.  Every shuffle is keyed on (session, position) or
finer, so neither a busy customer nor a long session is one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aislekit.operators.faults import draw
from aislekit.operators.sequence import neighbour, running_sum


def signed(event_type: Column) -> Column:
    return F.when(event_type == "Add to Cart", 1).when(event_type == "Remove from Cart", -1).otherwise(0)


def positions(replayed: DataFrame, key: str = "customer_id") -> DataFrame:
    """Events with ``cart_pos``: 1-based position inside (customer, cart epoch)."""
    d = replayed.withColumn("__one", F.lit(1))
    return running_sum(d, [key, "cart_epoch"], ["event_timestamp", "event_id"], "__one", "cart_pos").drop("__one")


def cart_changes(placed: DataFrame, key: str = "customer_id") -> DataFrame:
    """K04 change sets: per add or remove the signed count and the product's running count in the cart.

    -> (customer, cart_epoch, product_id, event_id, cart_pos, change, quantity).
    """
    c = placed.where(F.col("event_type").isin("Add to Cart", "Remove from Cart") & F.col("product_id").isNotNull()).select(
        key, "cart_epoch", "product_id", "event_id", "event_timestamp", "cart_pos", signed(F.col("event_type")).alias("change"))
    return running_sum(c, [key, "cart_epoch", "product_id"], ["event_timestamp", "event_id"], "change", "quantity") \
        .withColumn("quantity", F.col("quantity").cast("long"))


def cart_contents(placed: DataFrame, key: str = "customer_id") -> DataFrame:
    """The cart after every event as rows (event_id, product_id, n), n > 0.

    The rows are as many as the carts' distinct products, the size of the
    content itself; events with an empty cart have none.
    """
    changes = cart_changes(placed, key)
    nx = neighbour(changes, [key, "cart_epoch", "product_id"], ["event_timestamp", "event_id"], ["cart_pos"], "next")
    ends = placed.groupBy(key, "cart_epoch").agg(F.max("cart_pos").alias("__last"))
    held = nx.where(F.col("quantity") > 0).join(ends, [key, "cart_epoch"])
    until = F.coalesce(F.col("next_cart_pos") - 1, F.col("__last"))
    rows = held.select(key, "cart_epoch", "product_id", F.col("quantity").alias("n"),
                       F.explode(F.sequence(F.col("cart_pos"), until)).alias("cart_pos"))
    at = placed.select(key, "cart_epoch", "cart_pos", "event_id")
    return rows.join(at, [key, "cart_epoch", "cart_pos"]).select("event_id", "product_id", "n")


def purchased_rows(placed: DataFrame, key: str = "customer_id") -> DataFrame:
    """What each Payment Successful buys, as rows (event_id, product_id, quantity): the cart of the epoch it closes."""
    left = (placed.where(F.col("event_type").isin("Add to Cart", "Remove from Cart") & F.col("product_id").isNotNull())
            .groupBy(key, "cart_epoch", "product_id").agg(F.sum(signed(F.col("event_type"))).alias("quantity")).where("quantity > 0"))
    buys = placed.where(F.col("event_type") == "Payment Successful").select("event_id", key, (F.col("cart_epoch") - 1).alias("cart_epoch"))
    return buys.join(left, [key, "cart_epoch"]).select("event_id", "product_id", F.col("quantity").cast("long").alias("quantity"))


def change_sets(events: DataFrame, contents: DataFrame, places: DataFrame | None = None) -> DataFrame:
    """Products whose count differs from the previous event's cart in the session.

    ``events``: event_id, session_id, event_order (1, 2, ...).  -> (session_id,
    event_order, product_id, change); a first event has no previous cart and no rows.
    Only of ``places`` (session_id, event_order), if given: no other cart is shuffled by place.
    """
    here = events.where(F.col("event_order") > 1).select("event_id", "session_id", "event_order", F.lit(1).alias("__sign"))
    before = events.select("event_id", "session_id", (F.col("event_order") + 1).alias("event_order"), F.lit(-1).alias("__sign"))
    met = here.unionByName(before)
    if places is not None:
        met = met.join(places, ["session_id", "event_order"], "left_semi")
    return (contents.join(met, "event_id").groupBy("session_id", "event_order", "product_id")
            .agg(F.sum(F.col("n") * F.col("__sign")).alias("change")).where("change != 0"))


def wrong_cart_changes(events: DataFrame, contents: DataFrame, event_type: str) -> DataFrame:
    """X-cl10 / X-cl11: adds (removes) that don't raise (lower) their product by one, or that change another.

    -> (event_id, own_change, other_changes).
    """
    step = 1 if event_type == "Add to Cart" else -1
    own = events.where((F.col("event_type") == event_type) & F.col("product_id").isNotNull() & (F.col("event_order") > 1)) \
        .select("event_id", "session_id", "event_order", F.col("product_id").alias("__own"))
    places = own.select("session_id", "event_order")
    met = own.join(change_sets(events, contents, places), ["session_id", "event_order"], "left")
    mine = F.col("product_id") == F.col("__own")
    found = met.groupBy("event_id").agg(F.coalesce(F.sum(F.when(mine, F.col("change"))), F.lit(0)).alias("own_change"),
                                        F.count_if(~mine).alias("other_changes"))
    return found.where((F.col("own_change") != step) | (F.col("other_changes") > 0))


def cart_size_mismatches(events: DataFrame, contents: DataFrame) -> DataFrame:
    """X-cl12: events whose cart_size isn't the number of items in the cart; a missing size counts as wrong.

    -> (event_id, cart_size, items).
    """
    items = contents.groupBy("event_id").agg(F.sum("n").alias("items"))
    both = events.select("event_id", "cart_size").join(items, "event_id", "left").withColumn("items", F.coalesce("items", F.lit(0)))
    return both.where(~F.col("cart_size").eqNullSafe(F.col("items")))


def purchases_outside_cart(events: DataFrame, contents: DataFrame, purchased: DataFrame) -> DataFrame:
    """X-cl15: bought products that the session's previous cart doesn't hold -> (event_id, product_id)."""
    at = events.select("event_id", "session_id", "event_order")
    held = contents.join(at, "event_id").select("session_id", (F.col("event_order") + 1).alias("event_order"), "product_id")
    bought = purchased.join(at, "event_id").select("event_id", "session_id", "event_order", "product_id")
    return bought.join(held, ["session_id", "event_order", "product_id"], "left_anti").select("event_id", "product_id")


def break_carts(hits: DataFrame, contents: DataFrame, mode: str = "xxhash") -> tuple[DataFrame, DataFrame]:
    """E12 on the contents: partial loss, reset, none and explosion of the carts of ``hits`` (event_id, hit).

    The fault is drawn per event; a partial loss keeps the half of the items
    with the smallest draws, an explosion adds 10 to 30 of one drawn product.
    -> (contents after the faults, and per hit event its label and items).
    """
    sizes = contents.groupBy("event_id").agg(F.sum("n").alias("items"))
    r = draw(F.col("event_id"), 90, mode)
    some = F.col("items") > 0
    label = (F.when((r < 0.3) & some, "partial cart loss").when((r >= 0.3) & (r < 0.9) & some, "cart reset")
             .when((r >= 0.9) & (r < 0.95), "cart is none").when((r >= 0.95) & some, "cart explosion"))
    faults = (hits.where("hit").select("event_id").join(sizes, "event_id", "left")
              .withColumn("items", F.coalesce("items", F.lit(0))).withColumn("label", label).where(F.col("label").isNotNull()))
    c = contents.join(faults, "event_id", "left")

    def key(*cols: str) -> Column:
        return F.concat_ws("-", *cols)

    untouched = c.where(F.col("label").isNull()).select("event_id", "product_id", "n")
    units = c.where(F.col("label") == "partial cart loss").select(
        "event_id", "product_id", "items", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))).alias("unit"))
    by_draw = Window.partitionBy("event_id").orderBy(draw(key("event_id", "product_id", "unit"), 92, mode), "product_id", "unit")
    kept = (units.withColumn("__at", F.row_number().over(by_draw)).where(F.col("__at") <= F.floor(F.col("items") / 2))
            .groupBy("event_id", "product_id").agg(F.count(F.lit(1)).alias("n")))
    blown = c.where(F.col("label") == "cart explosion")
    pick = blown.groupBy("event_id").agg(F.min_by("product_id", F.struct(draw(key("event_id", "product_id"), 93, mode), "product_id")).alias("__p"))
    extra = (10 + F.floor(draw(F.col("event_id"), 91, mode) * 21)).cast("long")
    blown = blown.join(pick, "event_id").select("event_id", "product_id",
                                                F.when(F.col("product_id") == F.col("__p"), F.col("n") + extra).otherwise(F.col("n")).alias("n"))
    after = untouched.unionByName(kept).unionByName(blown)
    now = (F.when(F.col("label") == "partial cart loss", F.floor(F.col("items") / 2).cast("long")).when(F.col("label") == "cart reset", F.lit(0).cast("long"))
           .when(F.col("label") == "cart explosion", F.col("items") + extra))
    return after, faults.select("event_id", "label", now.alias("items"))
