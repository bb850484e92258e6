"""Dictionary encoding of raw transfers.

Codes are assigned in *first-seen* order, 0-based, like a dict that grows while the
file is read. Closed form: every occurrence of a value has a position
(``2*Index + slot`` for the two-column domains, receiving/from = slot 0), the value's
first position is ``min(position)``, and its code is the rank of that first position.
The rank is computed by :func:`rank_unique`, so no step funnels the table into one task.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import c, concat_key, epoch_seconds, midnight_epoch, parse_double, parse_long, parse_ts
from ..session import freeze
from .rank import MAX_BROADCAST_BUCKETS, rank_unique, with_row_index

# Encoded column layout.
ENCODED_COLUMNS = [
    "Index", "From_ID", "To_ID", "Timestamp", "Amount_Paid", "Payment_Currency",
    "Amount_Received", "Receiving_Currency", "Payment_Format", "Is_Laundering",
]
ANCHOR_OFFSET_SECONDS = 10
# Dictionaries up to this many entries are broadcast to the lookup join (size is counted first).
BROADCAST_DIM_ROWS = 1_000_000

DOMAINS = ("currency", "payment_format", "account")
KEY_COLUMNS = ("From Bank", "Account", "To Bank", "Account.1", "Receiving Currency", "Payment Currency", "Payment Format")
# Ids are ranked in value buckets up to this many times wider than their count, sorted beyond.
MAX_SPARSE = 1_000


@dataclass
class State:
    """Run state carried from one batch to the next."""

    anchor: int | None = None
    dims: dict[str, DataFrame] = field(default_factory=dict)
    edges: DataFrame | None = None
    batch_id: int = -1
    # What the last batch added; the store writes these and not the whole.
    new_dims: dict[str, DataFrame] | None = None
    new_edges: DataFrame | None = None
    # Folders of the stored parts that make up this state.
    parts: tuple[str, ...] = ()

    def dim(self, name: str) -> DataFrame | None:
        return self.dims.get(name)


def occurrences(raw: DataFrame, domain: str, delimiter: str = "") -> DataFrame:
    """(value, pos) for every occurrence of a domain value, ``raw`` carrying ``Index``."""
    i = F.col("Index")
    if domain == "currency":
        pairs = [(c("Receiving Currency"), 0), (c("Payment Currency"), 1)]
        width = 2
    elif domain == "payment_format":
        pairs = [(c("Payment Format"), 0)]
        width = 1
    elif domain == "account":
        pairs = [(concat_key("From Bank", "Account", delimiter=delimiter), 0),
                 (concat_key("To Bank", "Account.1", delimiter=delimiter), 1)]
        width = 2
    else:
        raise ValueError(domain)
    if width == 1:
        return raw.select(pairs[0][0].alias("value"), i.alias("pos"))
    arr = F.array(*[F.struct(v.alias("value"), (i * width + slot).alias("pos")) for v, slot in pairs])
    return raw.select(F.inline(arr))


def all_occurrences(raw: DataFrame, delimiter: str = "") -> DataFrame:
    """(domain, value, pos) for every domain from one scan: five occurrences per row."""
    i = F.col("Index")
    occ = [("currency", c("Receiving Currency"), i * 2), ("currency", c("Payment Currency"), i * 2 + 1),
           ("payment_format", c("Payment Format"), i),
           ("account", concat_key("From Bank", "Account", delimiter=delimiter), i * 2),
           ("account", concat_key("To Bank", "Account.1", delimiter=delimiter), i * 2 + 1)]
    return raw.select(F.inline(F.array(*[F.struct(F.lit(d).alias("domain"), v.alias("value"), p.alias("pos"))
                                         for d, v, p in occ])))


def first_seen_codes(occ: DataFrame, existing: DataFrame | None = None, existing_max: int | None = None,
                     pos_bounds: tuple[int, int] | None = None) -> DataFrame:
    """Dictionary (value, code) in first-seen order; extends ``existing`` with unseen values.

    ``pos_bounds`` (the position range, known from the batch size) saves a bounds scan.
    """
    first = occ.where(F.col("value").isNotNull()).groupBy("value").agg(F.min("pos").alias("first_pos"))
    base = 0
    if existing is not None:
        first = first.join(existing.select("value"), "value", "left_anti")
        if existing_max is None:
            existing_max = existing.agg(F.max("code")).first()[0]
        base = 0 if existing_max is None else int(existing_max) + 1
    coded = rank_unique(first, "first_pos", name="code", start=base, bounds=pos_bounds).select("value", "code")
    if existing is not None:
        coded = existing.select("value", "code").unionByName(coded)
    return coded


def extend_dictionary(dim: DataFrame, raw_indexed: DataFrame, domain: str, delimiter: str = "") -> DataFrame:
    """Lookup-or-insert - ``dim`` plus this batch's unseen values, coded after ``max(code)``
    in first-seen order (``raw_indexed`` carries the batch's ``Index``)."""
    return first_seen_codes(occurrences(raw_indexed, domain, delimiter), dim)


def fit_anchor(indexed: DataFrame, how: str = "first_row") -> int | None:
    """Midnight of the first row's day (or of the earliest row) minus 10 s, epoch seconds."""
    ts = parse_ts("Timestamp")
    if how == "first_row":  # the first row's text, then one text is parsed
        first = indexed.select(F.min_by(c("Timestamp"), F.col("Index")).alias("Timestamp")).select(
            midnight_epoch(ts).alias("m")).first()["m"]
    elif how == "min":
        first = indexed.select(F.min(midnight_epoch(ts)).alias("m")).first()["m"]
    else:
        raise ValueError(how)
    return None if first is None else int(first) - ANCHOR_OFFSET_SECONDS


def add_index(raw: DataFrame, order_by: str = "row_id", offset: int | None = None,
              n_rows: int | None = None) -> tuple[DataFrame, int]:
    """``Index`` restarts at 0 in every batch, following the batch's row order.

    Returns (frame with Index, number of rows). When the caller knows the batch is a
    contiguous run of ``order_by`` starting at ``offset`` with ``n_rows`` rows, no job runs.
    """
    if offset is not None and n_rows is not None:
        return raw.withColumn("Index", (F.col(order_by) - F.lit(offset)).cast("long")), n_rows
    lo, hi, n, total = raw.agg(F.min(order_by), F.max(order_by), F.count(order_by), F.count(F.lit(1))).first()
    if total == 0:
        return raw.withColumn("Index", F.lit(None).cast("long")), 0
    unique = n == total and raw.agg(F.count_distinct(order_by)).first()[0] == n
    if unique and hi - lo + 1 == n:  # already a dense sequence (a contiguous batch)
        return raw.withColumn("Index", (F.col(order_by) - F.lit(lo)).cast("long")), n
    if unique and hi - lo < MAX_SPARSE * n:
        return rank_unique(raw, order_by, name="Index", bounds=(lo, hi)), n
    # Repeated, missing or very sparse ids: a sorted index; equal ids follow their other columns.
    tie = F.xxhash64(*[c(x) for x in raw.columns])
    return with_row_index(raw, [order_by, tie], name="Index", return_count=True)


def new_first_seen_codes(occ: DataFrame, state: State, existing_max: dict, pos_range: int,
                         bucket_width: int = 1 << 20) -> DataFrame:
    """(domain, value, code) of the values not in the saved dictionaries, for every domain at once;
    their codes follow the saved dictionary's largest code (R6). Ranking uses fixed-width position buckets per
    domain, so no task holds more than ``bucket_width`` values."""
    first = occ.where(F.col("value").isNotNull()).groupBy("domain", "value").agg(F.min("pos").alias("first_pos"))
    if state.dims:
        saved = None
        for k, df in state.dims.items():
            t = df.select(F.lit(k).alias("domain"), "value")
            saved = t if saved is None else saved.unionByName(t)
        first = first.join(saved, ["domain", "value"], "left_anti")
    bucket = F.floor(F.col("first_pos") / F.lit(bucket_width)).cast("long")
    b = first.withColumn("_ll_b", bucket)
    pos = b.withColumn("_ll_r", F.row_number().over(
        Window.partitionBy("domain", "_ll_b").orderBy("first_pos")).cast("long"))
    sizes = b.groupBy("domain", "_ll_b").agg(F.count(F.lit(1)).alias("_ll_n"))
    base = F.create_map(*[x for k in DOMAINS for x in (F.lit(k), F.lit(
        0 if existing_max.get(k) is None else int(existing_max[k]) + 1).cast("long"))])
    offs = sizes.withColumn("_ll_off", F.coalesce(F.sum("_ll_n").over(
        Window.partitionBy("domain").orderBy("_ll_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        + base[F.col("domain")]).drop("_ll_n")
    n_buckets = len(DOMAINS) * (pos_range // bucket_width + 1)
    if n_buckets <= MAX_BROADCAST_BUCKETS:
        offs = F.broadcast(offs)
    return pos.join(offs, ["domain", "_ll_b"]).select(
        "domain", "value", (F.col("_ll_off") + F.col("_ll_r") - 1).cast("long").alias("code"))


def materialize(table: DataFrame, name: str = "dims") -> tuple[dict[str, DataFrame], dict[str, int]]:
    """Write the (domain, value, code) table partitioned by domain in one job, read it back
    and count every domain in one more job. Returns (per-domain frames, row counts)."""
    frozen = freeze(table, name, partition_by=["domain"])
    counts = dict(frozen.groupBy("domain").count().collect())
    out = {k: frozen.where(F.col("domain") == k).select("value", "code") for k in DOMAINS}
    return out, {k: int(counts.get(k, 0)) for k in DOMAINS}


def lookup(df: DataFrame, dim: DataFrame, key: Column, out: str, dim_rows: int | None = None) -> DataFrame:
    """Attach ``dim.code`` for ``key`` as ``out``; broadcast only when the dim is counted small."""
    d = dim.select(F.col("value").alias("_ll_v"), F.col("code").alias(out))
    if dim_rows is None:
        dim_rows = dim.count()
    if dim_rows <= BROADCAST_DIM_ROWS:
        d = F.broadcast(d)
    return df.join(d, key == F.col("_ll_v"), "left").drop("_ll_v")


def encode_transactions(raw: DataFrame, state: State | None = None, batch_id: int | None = None,
                        order_by: str = "row_id", on_error: str = "failfast", delimiter: str = "",
                        anchor: str = "first_row", index_offset: int | None = None, n_rows: int | None = None,
                        keep: list[str] | None = None):
    """Encode one batch of raw transfers.

    Returns ``(encoded, new_state)`` or, with ``on_error='quarantine'``,
    ``(encoded, new_state, rejects)``. ``state`` carries anchor and dictionaries from an
    earlier batch; unseen values get the next codes in first-seen order.
    """
    state = state or State()
    bid = state.batch_id + 1 if batch_id is None else batch_id
    indexed, n = add_index(raw, order_by, index_offset, n_rows)

    ts = parse_ts("Timestamp")
    paid, received, label = parse_double("Amount Paid"), parse_double("Amount Received"), parse_long("Is Laundering")
    bad = (ts.isNull() | paid.isNull() | received.isNull() | label.isNull())
    for x in KEY_COLUMNS:  # R17: a transfer without one of its keys has no place in the graph
        bad = bad | c(x).isNull()

    rejects = None
    if on_error == "quarantine":
        rejects = indexed.where(bad).withColumn("batch_id", F.lit(bid).cast("long"))
        indexed = indexed.where(~bad)
    elif on_error == "failfast":
        indexed = indexed.withColumn(
            "_ll_check",
            F.when(bad, F.raise_error(F.concat(F.lit("unparseable transfer at Index "), F.col("Index").cast("string")))))
    elif on_error != "null":
        raise ValueError(on_error)

    anchor_s = state.anchor if state.anchor is not None else fit_anchor(indexed, anchor)

    # All domains in one pass: (domain, value, first position) -> rank within domain.
    width = {"currency": 2, "payment_format": 1, "account": 2}
    existing_max = _max_codes(state) if state.dims else {}
    occ = all_occurrences(indexed, delimiter)
    fresh, counts = materialize(new_first_seen_codes(occ, state, existing_max, max(width.values()) * max(n, 1)))
    dims = {k: state.dims[k].unionByName(fresh[k]) if k in state.dims else fresh[k] for k in DOMAINS}
    sizes = {k: counts[k] + (0 if existing_max.get(k) is None else int(existing_max[k]) + 1) for k in DOMAINS}
    check = [F.col("_ll_check")] if on_error == "failfast" else []
    # Only numbers, codes and the two account keys reach the account lookups, which shuffle when the dictionary is large.
    keyed = indexed.select(
        F.col("Index").cast("long").alias("_ll_index"),
        concat_key("From Bank", "Account", delimiter=delimiter).alias("_ll_from"),
        concat_key("To Bank", "Account.1", delimiter=delimiter).alias("_ll_to"),
        (epoch_seconds(ts) - F.lit(anchor_s)).cast("double").alias("_ll_ts"),
        paid.alias("_ll_paid"), received.alias("_ll_received"), label.alias("_ll_label"),
        c("Receiving Currency").alias("_ll_rc"), c("Payment Currency").alias("_ll_pc"), c("Payment Format").alias("_ll_pf"),
        *[c(k).alias(f"_ll_keep{i}") for i, k in enumerate(keep or [])],
        *check,
    )
    keyed = lookup(keyed, dims["currency"], F.col("_ll_rc"), "Receiving_Currency", sizes["currency"])
    keyed = lookup(keyed, dims["currency"], F.col("_ll_pc"), "Payment_Currency", sizes["currency"])
    keyed = lookup(keyed, dims["payment_format"], F.col("_ll_pf"), "Payment_Format", sizes["payment_format"])
    keyed = lookup(keyed, dims["account"], F.col("_ll_from"), "From_ID", sizes["account"])
    keyed = lookup(keyed, dims["account"], F.col("_ll_to"), "To_ID", sizes["account"])

    encoded = keyed.select(
        F.col("_ll_index").alias("Index"), F.col("From_ID"), F.col("To_ID"),
        F.col("_ll_ts").alias("Timestamp"), F.col("_ll_paid").alias("Amount_Paid"), F.col("Payment_Currency"),
        F.col("_ll_received").alias("Amount_Received"), F.col("Receiving_Currency"),
        F.col("Payment_Format"), F.col("_ll_label").alias("Is_Laundering"),
        F.lit(bid).cast("long").alias("batch_id"),
        *[F.col(f"_ll_keep{i}").alias(k) for i, k in enumerate(keep or [])],
        *check,
    )
    if check:
        # keep the raise_error expression alive without exposing a column
        encoded = encoded.where(F.col("_ll_check").isNull()).drop("_ll_check")
    new_state = replace(state, anchor=anchor_s, dims=dims, batch_id=bid, new_dims=fresh, new_edges=None)
    if on_error == "quarantine":
        return encoded, new_state, rejects
    return encoded, new_state


def _max_codes(state: State) -> dict[str, int | None]:
    """Largest code of every saved dictionary, in one job."""
    tagged = None
    for k, df in state.dims.items():
        t = df.select(F.lit(k).alias("_ll_k"), F.col("code"))
        tagged = t if tagged is None else tagged.unionByName(t)
    return dict(tagged.groupBy("_ll_k").agg(F.max("code")).collect())


def label_encode(df: DataFrame, columns: list[str]) -> DataFrame:
    """M3: replace each column by the rank of its value among the column's sorted distinct values.

    One distributed index over all (column, value) pairs; a column's first code is 0.
    """
    pairs = None
    for i, name in enumerate(columns):
        p = df.select(F.lit(i).alias("_ll_col"), c(name).cast("string").alias("_ll_val")).distinct()
        pairs = p if pairs is None else pairs.unionByName(p)
    indexed, n_codes = with_row_index(pairs.where(F.col("_ll_val").isNotNull()), ["_ll_col", "_ll_val"],
                                      name="_ll_g", return_count=True)
    starts = indexed.groupBy("_ll_col").agg(F.min("_ll_g").alias("_ll_start"))  # one row per column
    codes = freeze(indexed.join(F.broadcast(starts), "_ll_col").select(
        "_ll_col", "_ll_val", (F.col("_ll_g") - F.col("_ll_start")).alias("_ll_code")), "label-codes")
    out = df
    for i, name in enumerate(columns):
        d = codes.where(F.col("_ll_col") == i).select(F.col("_ll_val").alias(f"_ll_v{i}"), F.col("_ll_code").alias(f"_ll_c{i}"))
        if n_codes <= BROADCAST_DIM_ROWS:  # all code tables together are under the bound
            d = F.broadcast(d)
        out = out.join(d, c(name).cast("string") == F.col(f"_ll_v{i}"), "left")
    cols = [F.col(f"_ll_c{columns.index(x)}").alias(x) if x in columns else c(x) for x in df.columns]
    return out.select(*cols)
