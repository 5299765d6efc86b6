import datetime as dt

import pytest
from pyspark.sql import functions as F

from reclink.plans.intake import feed_run, import_disclosure, process_imports
from reclink.schemas import IMPORTS, LISTING
from reclink.sources import disclosures as S
from reclink.sources import feed, queue

def now():
    return F.lit("2024-01-01").cast("timestamp_ntz")


def test_headers(spark):
    df = spark.createDataFrame([("1", "a", "b", "z", "w")], ["CASE_NO", "Employer_Name", "employer_name", "Extra", "basic_unit_of_pay"])
    row = S.normalize_headers(df).first().asDict()
    assert row == {"case_number": "1", "employer_name": "b", "per": "w"}
    assert [tuple(r) for r in S.unknown_headers(df).collect()] == [("extra", 1)]


def test_casts(spark):
    rows = [("x", "-5", "12.50", "yes", "2020-01-02"), ("y", "7", "-1", "maybe", "soon")]
    typed, rejects = S.cast_to_schema(
        spark.createDataFrame(rows, "case_number string, total_units string, wage_offer string, emergency_filing string, decision_date string")
    )
    first, second = typed.orderBy("case_number").collect()
    assert (first.total_units, float(first.wage_offer), first.emergency_filing) == (None, 12.5, True)
    assert first.decision_date == dt.date(2020, 1, 2)
    assert (second.total_units, second.wage_offer, second.emergency_filing, second.decision_date) == (7, None, None, None)
    assert sorted((r.case_number, r.column) for r in rejects.collect()) == [
        ("x", "total_units"), ("y", "decision_date"), ("y", "emergency_filing"), ("y", "wage_offer")
    ]


def test_row_numbers_run_across_chunks(spark, monkeypatch):
    monkeypatch.setattr(S, "NUMBERING_CHUNK", 7)
    df = spark.range(0, 200, 3).select(F.col("id").alias("position"), (F.col("id") % 2).cast("string").alias("file_name"))
    for name in ("0", "1"):
        rows = S.number_rows(df, "file_name", "position").where(F.col("file_name") == name).orderBy("position").collect()
        assert [r.row_number for r in rows] == list(range(1, len(rows) + 1))


def test_resumed_import_loads_the_rest_once(spark):
    whole = spark.createDataFrame([("f", i) for i in range(1, 11)] + [("g", 1)], "file_name string, file_row int")
    files = whole.groupBy("file_name").agg((F.count("*") + 1).alias("n_rows"))
    loaded = whole.where("file_name = 'f' and file_row <= 4")
    offsets = {r.file_name: (r.next_row, r.done) for r in S.resume_offset(loaded, files).collect()}
    assert offsets == {"f": (4, False), "g": (0, False)}
    rest = S.import_remaining(whole, loaded)
    assert rest.count() == 7 and loaded.unionByName(rest).distinct().count() == whole.count()
    assert S.resume_offset(whole, files).where("done").count() == 2


def test_queue(spark):
    body = (
        '{"Records":[{"s3":{"bucket":{"name":"TEST_NAME"},"object":{"key":"TEST_KEY"}}},'
        '{"s3":{"bucket":{"name":"TEST_NAME_2"},"object":{"key":"a+b%2Cc"}}}]}'
    )
    names = queue.decode_object_events(spark.createDataFrame([(body,)], "body string"))
    assert sorted(tuple(r) for r in names.collect()) == [("TEST_NAME", "TEST_KEY"), ("TEST_NAME_2", "a b,c")]
    state = queue.register_import(spark.createDataFrame([], IMPORTS), names, now())
    for left in (1, 0):
        state = queue.finish_imports(state, queue.pending_imports(state), now())
        assert state.where("status = 'Needs Importing'").count() == left
    assert state.where("status = 'Finished'").count() == 2


@pytest.mark.parametrize(
    ("fetch", "wanted"),
    [
        (("broken", 200, "rss20"), "parse error"),
        ((None, 403, "rss20"), "bad status"),
        ((None, 200, ""), "no new entries"),
        ((None, 301, "rss20"), "accepted"),
    ],
)
def test_feed_gate(spark, fetch, wanted):
    df = spark.createDataFrame([(1, *fetch)], "fetch_id bigint, parse_error string, status int, version string")
    assert feed.feed_accept(df).first().outcome == wanted


def entries(spark, *links):
    rows = [(i + 1, link, f"t{i}", "d", dt.datetime(2012, 6, 11)) for i, link in enumerate(links)]
    return spark.createDataFrame(rows, "position int, link string, title string, description string, published timestamp_ntz")


def test_feed_entries(spark):
    good = entries(spark, *[f"https://x/H-{i}" for i in range(1, 6)])
    listings = feed.upsert_listings(feed.empty_listings(spark), feed.feed_valid(good), now())
    assert listings.count() == 5 and listings.first().pub_date == "2012-06-11"
    mixed = entries(spark, "https://x/none", "https://x/H-1?H-2", "https://x/H-1", "https://x/H-1")
    assert feed.feed_valid(mixed).count() + feed.feed_rejects(mixed).count() == mixed.count()
    assert sorted(r.reason for r in feed.feed_rejects(mixed).collect()) == ["no id", "several ids"]
    assert feed.feed_valid(feed.feed_head(mixed, 3)).count() == 1 and feed.feed_head(mixed, 0).count() == 4
    valid = feed.feed_valid(mixed)
    titles = {r.dol_id: r.title for r in feed.upsert_listings(listings, valid, now()).collect()}
    assert titles["H-1"] == "t3" and len(titles) == 5
    assert {r.dol_id: r.title for r in feed.upsert_listings(listings, valid, now(), True).collect()}["H-1"] == "t0"
    fresh = feed.upsert_listings(feed.empty_listings(spark), valid, now(), skip_update=True)
    assert [r.title for r in fresh.collect()] == ["t2"]
    once = feed.upsert_listings(listings, valid, now())
    assert sorted(map(str, feed.upsert_listings(once, valid, now()).collect())) == sorted(map(str, once.collect()))
    report = feed.upsert_report(feed.empty_listings(spark), valid).orderBy("position").collect()
    assert [r.operation for r in report] == ["created", "updated"]


def test_cursor(spark):
    fetch = spark.createDataFrame(
        [(1, "6c132-941-ad7e3080", "Fri, 11 Jun 2012 23:00:34 GMT")], "fetch_id bigint, etag string, modified string"
    )
    state = spark.createDataFrame([("jobs_rss__etag", "old")], "key string, value string")
    assert {r.key: r.value for r in feed.save_cursor(state, fetch).collect()} == {
        "jobs_rss__etag": "6c132-941-ad7e3080",
        "jobs_rss__modified": "Fri, 11 Jun 2012 23:00:34 GMT",
    }
    silent = spark.createDataFrame([(2, "", None)], fetch.schema)
    assert [r.value for r in feed.save_cursor(state, silent).collect()] == ["old"]


def listings(spark, *ids):
    rows = [tuple({"dol_id": i, "scraped": False}.get(c) for c in LISTING.names) for i in ids]
    return spark.createDataFrame(rows, LISTING)


@pytest.mark.parametrize(
    ("status", "body", "outcome"),
    [
        (403, "{}", "bad status"),
        (200, "not json", "invalid json"),
        (200, '{"value":[]}', "no value"),
        (200, '{"value":[{"a_key":"a value","case_number":"H-1"}]}', "parsed"),
    ],
)
def test_responses(spark, status, body, outcome):
    responses = spark.createDataFrame([("H-1", status, body)], "requested_id string, status int, body string")
    parsed = feed.parse_responses(responses)
    assert parsed.first().outcome == outcome
    stored = listings(spark, "H-1")
    done = feed.apply_payloads(stored, feed.route_responses(stored, parsed)).first()
    assert done.scraped == (outcome == "parsed")
    if done.scraped:
        assert '"a_key":"a value"' in done.scraped_data


def test_mismatched_case_numbers(spark):
    body = '{"value":[{"case_number":"H-2"}]}'
    parsed = feed.parse_responses(spark.createDataFrame([("H-1", 200, body)], "requested_id string, status int, body string"))
    one = feed.route_responses(listings(spark, "H-1", "H-2"), parsed).first()
    assert (one.dol_id, one.successful) == ("H-2", True)
    assert not feed.route_responses(listings(spark, "H-1", "H-2", "H-2"), parsed).first().successful
    assert not feed.route_responses(listings(spark, "H-1"), parsed).first().successful


def test_documents(spark):
    fetched = spark.createDataFrame(
        [("H-1", 200, "https://x"), ("H-2", 200, feed.MISSING_DOCUMENT), ("H-3", 500, "https://x")],
        "dol_id string, status int, url string",
    )
    stored = listings(spark, "H-1", "H-2", "H-3")
    pdf = {r.dol_id: r.pdf for r in feed.attach_documents(stored, fetched, "bucket").collect()}
    assert pdf["H-1"].endswith("/H-1.pdf") and pdf["H-2"] is None and pdf["H-3"] is None
    assert sorted(r.dol_id for r in feed.attach_failures(stored, fetched).collect()) == ["H-2", "H-3"]


def test_head_of_each_fetch(spark):
    rows = [(f, p) for f in (1, 2) for p in range(0, 20, 2)]
    entries = spark.createDataFrame(rows, "fetch_id int, position int")
    assert sorted(tuple(r) for r in feed.feed_head(entries, 3).collect()) == [(f, p) for f in (1, 2) for p in (0, 2, 4)]
    assert [r.position for r in feed.feed_head(entries.where("fetch_id = 1").drop("fetch_id"), 2).orderBy("position").collect()] == [0, 2]


def test_rows_without_a_position_stay(spark):
    df = spark.createDataFrame([("f", 5), ("f", None), ("f", 1), ("g", None)], "file_name string, position long")
    got = sorted((r.file_name, r.position or 0, r.n) for r in S.number_rows(df, "file_name", "position", "n").collect())
    assert got == [("f", 0, 3), ("f", 1, 1), ("f", 5, 2), ("g", 0, 1)]


HEADERS = ["CASE_NO", "Received_Date", "employer_name", "EMPLOYER_ADDRESS1", "employer_city", "employer_state", "employer_phone", "odd"]


def csv_file(path, headers, rows):
    import csv

    with open(path, "w", newline="") as file:
        csv.writer(file).writerows([headers, *rows])
    return str(path)


def test_files_of_several_years(spark, tmp_path):
    """Other header orders, line breaks in cells, a refused cell and an interrupted import."""
    row = {"CASE_NO": "c", "Received_Date": "2022-01-02 00:00:00", "employer_name": "Acme", "EMPLOYER_ADDRESS1": "12 road\nbox 3",
           "employer_city": "Ames", "employer_state": "iowa", "employer_phone": "919-222-2222", "odd": "x"}
    one = [[{**row, "CASE_NO": f"a{i}"}[h] for h in HEADERS] for i in range(4)]
    turned = HEADERS[::-1]
    two = [[{**row, "CASE_NO": f"b{i}", "Received_Date": "soon" if i else row["Received_Date"]}[h] for h in turned] for i in range(3)]
    paths = [csv_file(tmp_path / "H-2A one.csv", HEADERS, one), csv_file(tmp_path / "h-2b_two.csv", turned, two)]
    loaded = spark.createDataFrame([("H-2A one.csv", 1), ("H-2A one.csv", 2)], "file_name string, file_row int")
    out = import_disclosure(spark, paths, loaded, root=str(tmp_path))
    rows = sorted(
        (r.file_name, r.file_row, r.case_number, r.employer_name, r.employer_city, r.employer_state, r.visa_class) for r in out.rows.collect()
    )
    assert rows == [("H-2A one.csv", 3, "a2", "Acme", "Ames", "IA", "H-2A"), ("H-2A one.csv", 4, "a3", "Acme", "Ames", "IA", "H-2A")] + [
        ("h-2b_two.csv", i + 1, f"b{i}", "Acme", "Ames", "IA", "H-2B") for i in range(3)
    ]
    assert sorted((r.file_name, r.case_number, r.column, r.value) for r in out.rejects.collect()) == [
        ("h-2b_two.csv", "b1", "received_date", "soon"),
        ("h-2b_two.csv", "b2", "received_date", "soon"),
    ]
    assert [(r.header, r.filled) for r in out.unknown.collect()] == [("odd", 7)]


def test_files_of_one_name_are_apart(spark, tmp_path):
    """Equal names in folders, also where one path ends like another, a resume, and names with odd characters."""
    paths = []
    for folder, count in (("year1", 3), ("year2", 2), ("ab", 2), ("b", 1), ("x y+z%41", 1)):
        (tmp_path / folder).mkdir()
        rows = [[f"{folder}{i}", "2022-01-02 00:00:00", "Acme", "r", "Ames", "NC", "1", "z"] for i in range(count)]
        paths.append(csv_file(tmp_path / folder / "H-2A.csv", HEADERS, rows))
    root = str(tmp_path)
    first = import_disclosure(spark, paths[:1], root=root).rows
    rest = import_disclosure(spark, paths, first, root=root).rows
    got = sorted((r.file_name, r.file_row, r.case_number) for r in rest.collect())
    assert got == [("ab/H-2A.csv", 1, "ab0"), ("ab/H-2A.csv", 2, "ab1"), ("b/H-2A.csv", 1, "b0")] + [
        ("x y+z%41/H-2A.csv", 1, "x y+z%410"), ("year2/H-2A.csv", 1, "year20"), ("year2/H-2A.csv", 2, "year21")
    ]
    whole = import_disclosure(spark, paths[:2]).rows.select("file_name").distinct().collect()
    assert {r.file_name for r in whole} == {f"file:{p}" for p in paths[:2]}


def test_a_thousand_files_in_one_plan(spark, tmp_path):
    paths = [csv_file(tmp_path / f"H-2A {i}.csv", HEADERS[:3], [[f"c{i}", "2022-01-02 00:00:00", "Acme"]]) for i in range(1000)]
    rows = import_disclosure(spark, paths, root=str(tmp_path)).rows.select("file_name", "file_row", "case_number").collect()
    assert sorted((r.file_name, r.case_number) for r in rows) == sorted((f"H-2A {i}.csv", f"c{i}") for i in range(1000))
    assert {r.file_row for r in rows} == {1}


def test_queue_to_rows(spark, tmp_path):
    """Files are imported in order of their arrival, marked, and not imported again."""
    (tmp_path / "bucket").mkdir()
    for name in ("x_H-2A.csv", "y_H-2B.csv"):
        csv_file(tmp_path / "bucket" / name, HEADERS, [[name, "2022-01-02 00:00:00", "Acme", "r", "Ames", "NC", "1", "z"]])
    names = spark.createDataFrame([("bucket", "x_H-2A.csv"), ("bucket", "y_H-2B.csv")], "bucket string, object string")
    waiting = queue.register_import(spark.createDataFrame([], IMPORTS), names, now())
    loaded = import_disclosure(spark, [str(tmp_path / "bucket" / "x_H-2A.csv")]).rows.limit(0)
    first = process_imports(spark, waiting, loaded, str(tmp_path), now())
    assert [r.case_number for r in first.loaded.collect()] == ["x_H-2A.csv"]
    assert sorted((r.object, r.status) for r in first.queue.collect()) == [("x_H-2A.csv", "Finished"), ("y_H-2B.csv", "Needs Importing")]
    second = process_imports(spark, first.queue, first.loaded, str(tmp_path), now(), n=5)
    assert sorted(r.case_number for r in second.loaded.collect()) == ["x_H-2A.csv", "y_H-2B.csv"]
    last = process_imports(spark, second.queue, second.loaded, str(tmp_path), now())
    assert last.loaded.count() == 2 and last.rejects.count() == 0


def test_refused_fetches_change_nothing(spark):
    fetches = spark.createDataFrame(
        [(1, None, 200, "rss20", "e1", None), (2, "broken", 200, "rss20", "e2", "m2"), (3, None, 403, "rss20", "e3", None)],
        "fetch_id int, parse_error string, status int, version string, etag string, modified string",
    )
    entries = spark.createDataFrame(
        [(f, p, f"https://x/H-300-{f}{p}", "t", "d", dt.datetime(2024, 1, 1)) for f in (1, 2, 3) for p in (0, 1)],
        "fetch_id int, position int, link string, title string, description string, published timestamp_ntz",
    )
    listings = spark.createDataFrame([], LISTING)
    state = spark.createDataFrame([], "key string, value string")
    run = feed_run(fetches, entries, listings, state, now())
    assert sorted(r.dol_id for r in run.listings.collect()) == ["H-300-10", "H-300-11"]
    assert [(r.key, r.value) for r in run.state.collect()] == [("jobs_rss__etag", "e1")]
    assert run.report.where("operation = 'created'").count() == 2 and run.rejects.count() == 0
    none = feed_run(fetches.where("fetch_id > 1"), entries, run.listings, run.state, now())
    assert none.listings.count() == 2 and none.state.count() == 1 and none.report.count() == 0
