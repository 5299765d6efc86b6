"""Whole steps over stored tables: each reads one version, commits the next one at once, and leaves no scratch tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reclink.plans.intake import process_imports
from reclink.plans.linkage import link_mentions, link_table, update_employers
from reclink.plans.resolution import canonicalize_all
from reclink.session import cut, scratch_scope
from reclink.sources.feed import merge_offered
from reclink.sources.store import Store
from reclink.streaming.jobs import latest_batch, merge_feed, read_batches


def run_imports(store: Store, root: str, now: Column, n: int = 1) -> int:
    """Import the first n waiting files of `imports` into `disclosures`; rows and marks of a file come in one version.

    Rows are appended in a folder of their own, and refused cells to `rejects`. Without a waiting file nothing is written.
    """
    base = store.current()
    loaded, waiting = store.read("disclosures", base), store.read("imports", base)
    with scratch_scope(store.spark):
        run = process_imports(store.spark, waiting, loaded, root, now, n)
        if run.rows is None:
            return base
        rows = loaded.limit(0).unionByName(run.rows, allowMissingColumns=True).select(*loaded.columns)
        return store.commit({"imports": run.queue}, {"disclosures": rows, "rejects": run.rejects}, base)


def run_employers(store: Store, **options) -> int:
    """Collapse `disclosures` and `listings` to `employers` and store all three in one version."""
    base = store.current()
    with scratch_scope(store.spark):
        made = update_employers(*[store.read(name, base) for name in ("disclosures", "listings", "employers")], **options)
        return store.commit({"disclosures": made.disclosures, "listings": made.listings, "employers": made.employers}, base=base)


def run_added_employers(store: Store, table: str = "disclosures", linked: str = "linked_disclosures", slug_mode: str = "lower") -> int:
    """Collapse only the rows that were appended to `table` since the last call; earlier rows are not read.

    New rows with an unknown key make an employer, rows with a known one take its id and widen its seen dates, as smallest
    and largest dates of parts can be merged. The linked rows are appended to `linked`, and `progress` notes the version
    up to which `table` is done, all in one version with the employers. Ids and dates are those of one run over all rows;
    the texts of an employer are those of the arrival that made it. A date that is missing where an employer is made stays
    missing. Without new rows nothing is written. Raises ValueError if `table` was replaced since, and KeyError if the
    noted version has expired.
    """
    base = store.current()
    arrived = store.added(table, _done(store, base, table) or 0, base)
    if arrived.isEmpty():
        return base
    with scratch_scope(store.spark):
        rows, employers = link_table(arrived, store.read("employers", base), slug_mode)
        return store.commit({"employers": employers, "progress": _noted(store, base, table, base + 1)}, {linked: rows}, base)


def run_streamed_addresses(store: Store, out: str) -> int:
    """Take the batches that `stream_addresses` wrote to `out` into `addresses`, `order_links` and `employer_links`.

    A text that is stored keeps its id, whatever that is; unknown texts become records. Each batch is taken once: its number
    is noted in `progress` under the path, in the same version as the tables, so a call that is repeated, or that died, adds
    nothing twice. Orders that have an address already are passed by, as in update_addresses. Without new batches nothing
    is written.
    """
    base = store.current()
    done, latest = _done(store, base, out), latest_batch(store.spark, out)
    if latest is None or (done is not None and done >= latest):
        return base
    fresh = read_batches(store.spark, out).where(F.col("batch").between((-1 if done is None else done) + 1, latest))
    names = ("addresses", "order_links", "employer_links")
    stored = [store.read(name, base) for name in names]
    with scratch_scope(store.spark):
        linked = stored[1].select("disclosure_id").distinct()
        mentions = cut(fresh.drop("batch", "address_record_id").join(linked, "disclosure_id", "left_anti"), "mentions")
        made = link_mentions(mentions, *stored)
        return store.commit({**dict(zip(names, made)), "progress": _noted(store, base, out, latest)}, base=base)


def run_streamed_feed(store: Store, out: str) -> int:
    """Take the batches that `stream_feed` wrote to `out` into `listings`; returns the version that holds them.

    `offered` keeps the last entry of each id with its place in the feed, so an entry that arrives late does not replace one
    that stands after it: however the entries are dealt over batches and calls, the listings are those of one upsert of all.
    Each batch is taken once, as in run_streamed_addresses. Only listings that new batches name are merged again; scraped
    fields of the others, and all fields that the feed does not carry, stay as they are stored.
    """
    base = store.current()
    done, latest = _done(store, base, out), latest_batch(store.spark, out)
    if latest is None or (done is not None and done >= latest):
        return base
    fresh = read_batches(store.spark, out).where(F.col("batch").between((-1 if done is None else done) + 1, latest))
    with scratch_scope(store.spark):
        touched = merge_feed(fresh)
        if "offered" in store.tables(base):
            known = store.read("offered", base)
            rows = fresh.unionByName(known.join(fresh.select("dol_id").distinct(), "dol_id", "left_semi"))
            touched = cut(merge_feed(rows), "touched")
            offered = touched.unionByName(known.join(touched.select("dol_id"), "dol_id", "left_anti"))
        else:
            touched = offered = cut(touched, "touched")
        listings = merge_offered(store.read("listings", base), touched)
        return store.commit({"listings": listings, "offered": offered, "progress": _noted(store, base, out, latest)}, base=base)


PROGRESS = "name string, done bigint"


def _progress(store: Store, base: int) -> DataFrame:
    """What each input was last read up to: a version of a table, or a batch of a stream."""
    return store.read("progress", base) if "progress" in store.tables(base) else store.spark.createDataFrame([], PROGRESS)


def _done(store: Store, base: int, name: str) -> int | None:
    return _progress(store, base).where(F.col("name") == name).agg(F.max("done")).first()[0]


def _noted(store: Store, base: int, name: str, done: int) -> DataFrame:
    others = _progress(store, base).where(F.col("name") != name)
    return others.unionByName(store.spark.createDataFrame([(name, done)], PROGRESS))


def run_canonical(store: Store, distance=None) -> int:
    """Canonical records of the clusters in `entity_map`, stored with links, marks and errors in one version."""
    base = store.current()
    with scratch_scope(store.spark):
        made = canonicalize_all(*[store.read(name, base) for name in ("employers", "entity_map", "uniques")], distance=distance)
        tables = {"employers": made.employers, "entity_map": made.entity_map, "uniques": made.uniques, "errors": made.errors}
        return store.commit(tables, base=base)
