import datetime as dt
import itertools
import random

import pytest
from pyspark.sql import functions as F

from reclink.functions.text import USA
from reclink.operators import blocking as B
from reclink.operators import canonical as K
from reclink.operators import clusters as C
from reclink.operators import pairs as P
from reclink.operators import review as R
from reclink.operators import training as L
from reclink.operators.clean import clean_disclosure, clean_listing
from reclink.plans.linkage import update_addresses, update_employers
from reclink.plans.resolution import canonicalize_clusters, link_records
from reclink.schemas import (
    ADDRESS,
    EMPLOYER,
    EMPLOYER_ADDRESS_LINK,
    ENTITY_MAP,
    IDENTITY,
    LISTING,
    ORDER_ADDRESS_LINK,
    SOURCE_DISCLOSURE,
    UNIQUE_EMPLOYER,
)


def day(text):
    return dt.datetime.fromisoformat(text)


DISCLOSURE = (
    "id bigint, employer_name string, trade_name_dba string, employer_address_1 string, employer_address_2 string, "
    "employer_city string, employer_state string, employer_postal_code string, employer_country string, "
    "employer_phone string, phone_to_apply string, worksite_address string, worksite_city string, worksite_state string, "
    "worksite_postal_code string, first_seen timestamp_ntz, last_seen timestamp_ntz, source string, "
    "employer_record_id string"
)


def order(number, name, trade, city, office, worksite, first, last):
    a1, a2, zip_code = office
    return (
        number, name, trade, a1, a2, city, "California", zip_code, USA, None, None, *worksite, day(first), day(last),
        SOURCE_DISCLOSURE, None,
    )


NO_SITE = (None, None, None, None)
D1 = order(1, "Test business", "Test trade name", "Test city", ("Address 1", None, "Test zip "),
           ("Test address 123", "Test city #2", "NC", "12345"), "1999-01-01", "2000-01-01")
D2 = order(2, "Test business", "TEST TRADE NAME", "TEST CITY", ("Address 1", "Address 2", "Test zip 2"), NO_SITE,
           "1999-01-01", "2002-01-01")
D3 = order(3, "test business #2", None, "Test city", ("Address 1", "Address 2", "Test zip 2"), NO_SITE,
           "2003-01-01", "2004-01-01")
D4 = order(4, "test business #2", None, "Test city", ("Address 1", "Address 2", "Test zip 2"), NO_SITE,
           "2003-01-01", "2007-01-01")


def disclosures(spark, *rows):
    return clean_disclosure(spark.createDataFrame(list(rows), DISCLOSURE))


def listing(spark, dol_id, name, phone, first, last):
    body = (
        f'{{"employer_business_name":"{name}","employer_trade_name":"Test trade name","employer_city":"Test city",'
        f'"employer_state":"California","employer_phone":"{phone}"}}'
    )
    values = {"dol_id": dol_id, "scraped": True, "scraped_data": body, "employer_country": USA, "first_seen": day(first),
              "last_seen": day(last), "source": "scraper"}
    return tuple(values.get(c) for c in LISTING.names)


def test_exact_linkage(spark):
    rows = [
        listing(spark, "H-1", " Test business ", "", "2005-01-01", "2010-01-01"),
        listing(spark, "H-2", " Test business #3 ", "1234578", "2005-01-01", "2005-01-01"),
    ]
    listings = clean_listing(spark.createDataFrame(rows, LISTING))
    out = update_employers(disclosures(spark, D1, D2, D3), listings, spark.createDataFrame([], EMPLOYER))
    employers = {r.name: r for r in out.employers.collect()}
    assert set(employers) == {"Test business", "test business #2", "Test business #3"}
    first = employers["Test business"]
    assert (first.first_seen, first.last_seen) == (day("1999-01-01"), day("2010-01-01"))
    assert (first.slug, first.trade_name_slug) == ("test business", "test trade name")
    links = {r.id: r.employer_record_id for r in out.disclosures.collect()}
    assert links[1] == links[2] == first.id != links[3]
    assert {r.dol_id: r.employer_record_id for r in out.listings.collect()}["H-1"] == first.id


def test_addresses_in_two_rounds(spark):
    no = spark.createDataFrame([], ADDRESS), spark.createDataFrame([], ORDER_ADDRESS_LINK)
    no_links = spark.createDataFrame([], EMPLOYER_ADDRESS_LINK)
    empty = spark.createDataFrame([], EMPLOYER)
    no_listings = spark.createDataFrame([], LISTING)
    linked = update_employers(disclosures(spark, D1, D2, D3), no_listings, empty)
    one = update_addresses(linked.disclosures, *no, no_links)
    assert one.addresses.count() == 3
    per_order = {r.disclosure_id: r["count"] for r in one.order_links.groupBy("disclosure_id").count().collect()}
    assert per_order == {1: 2, 2: 1, 3: 1}
    from reclink.functions.text import format_address
    from reclink.operators.clean import ADDRESS_PARTS

    texts = {r[0] for r in one.addresses.select(format_address(*ADDRESS_PARTS)).collect()}
    assert "Address 1, Test City, CA Test zip UNITED STATES OF AMERICA" in texts
    assert "Test Address 123, Test City #2, NC 12345 UNITED STATES OF AMERICA" in texts
    names = {r.id: r.name for r in linked.employers.collect()}
    held = [(names[r.employer_record_id], r) for r in one.employer_links.collect()]
    assert sorted(n for n, _ in held) == ["Test business"] * 3 + ["test business #2"]

    again = update_employers(disclosures(spark, D1, D2, D3, D4), no_listings, linked.employers)
    two = update_addresses(again.disclosures, one.addresses, one.order_links, one.employer_links)
    assert two.addresses.count() == 3
    number_two = [r for r in two.employer_links.collect() if names[r.employer_record_id] == "test business #2"]
    assert [(r.first_seen, r.last_seen) for r in number_two] == [(day("2003-01-01"), day("2007-01-01"))]


def employer(number, name, trade="Test trade name", city="Test city", phone=None, **values):
    base = {"id": number, "name": name, "trade_name_dba": trade, "city": city, "state": "CA", "country": USA,
            "phone": phone, "first_seen": day("2022-09-30"), "last_seen": day("2022-09-30"), "source": "scraper"}
    base.update(values)
    return tuple(base.get(c) for c in EMPLOYER.names)


def members(spark, *names):
    rows = [("c", *employer(str(i), *n)) for i, n in enumerate(names)]
    return spark.createDataFrame(rows, "canon_id string, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in EMPLOYER))


def test_canonical_values(spark):
    two = K.canonical_values(members(spark, ("Value1", "Value2", None), ("value1", "value2", "value3"))).first()
    assert (two.name, two.trade_name_dba, two.city, two.phone) == ("Value1", "Value2", "value3", None)
    names = ("Value1", "Value2", None), ("value1", "value2", "value3"), ("VALUE1", "VALUE2", "")
    three = K.canonical_values(members(spark, *names)).first()
    assert (three.name, three.trade_name_dba, three.city) == ("Value1", "Value2", "value3")
    from reclink.functions.distance import affine_gap

    gap = K.canonical_values(members(spark, *names), distance=affine_gap).first()
    assert (gap.name, gap.trade_name_dba) == ("Value1", "Value2")
    same = K.canonical_values(members(spark, ("x", "", None), ("x", "", None))).first()
    assert (same.name, same.trade_name_dba) == ("x", None)


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_medoid_of_a_large_cluster(spark, monkeypatch):
    monkeypatch.setattr(K, "VALUES_PER_PART", 40)
    random.seed(3)
    names = ["".join(random.choice("abcd") for _ in range(random.randint(3, 9))) for _ in range(150)]
    rows = [("c", *employer(f"{i:04}", n)) for i, n in enumerate(names)]
    df = spark.createDataFrame(rows, "canon_id string, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in EMPLOYER))
    totals = [(sum(distance(a, b) for b in names), i) for i, a in enumerate(names)]
    assert K.canonical_values(df).first().name == names[min(totals)[1]]


def entity_map(spark, *rows):
    return spark.createDataFrame([(i, c, s, v, None, p) for i, c, s, v, p in rows], ENTITY_MAP)


def test_clusters_to_unique_employers(spark):
    employers = spark.createDataFrame(
        [employer("1", "Test name"), employer("2", "Test name 2"), employer("3", "Test name 3")], EMPLOYER
    )
    stored = entity_map(spark, ("1", "1", 0.9, None, False), ("2", "1", 0.9, None, False), ("3", "1", 0.5, None, False))
    out = canonicalize_clusters(employers, stored, spark.createDataFrame([], UNIQUE_EMPLOYER))
    unique = out.uniques.collect()
    assert [(u.name, u.trade_name_dba) for u in unique] == [("Test name", "Test trade name")]
    ids = {r.id: r.unique_employer_id for r in out.employers.collect()}
    assert ids == {"1": unique[0].id, "2": unique[0].id, "3": None}
    assert {r.employer_record_id: r.processed for r in out.entity_map.collect()} == {"1": True, "2": True, "3": False}

    # A member approved later joins what its cluster already has.
    approved = out.entity_map.withColumn("is_valid_cluster", F.col("employer_record_id") == "3")
    later = canonicalize_clusters(out.employers, approved, out.uniques)
    assert {r.unique_employer_id for r in later.employers.collect()} == {unique[0].id}
    assert later.uniques.count() == 1


def test_clusters_with_equal_fields_share_one_unique_employer(spark):
    employers = spark.createDataFrame([employer(str(i), "Same") for i in range(4)], EMPLOYER)
    stored = entity_map(spark, *[(str(i), str(i // 2), 0.9, None, False) for i in range(4)])
    out = canonicalize_clusters(employers, stored, spark.createDataFrame([], UNIQUE_EMPLOYER))
    assert out.uniques.count() == 1


def test_singletons(spark):
    employers = spark.createDataFrame([employer(str(i), f"Test name {i}") for i in (1, 2, 3)], EMPLOYER)
    stored = entity_map(spark, ("1", "1", 0.9, None, False), ("2", "1", 0.9, None, False))
    uniques, linked = K.singleton_uniques(employers, stored)
    assert [(u.name, u.sources) for u in uniques.collect()] == [("Test name 3", ["scraper"])]
    assert [r.id for r in linked.where("unique_employer_id is not null").collect()] == ["3"]


def test_review(spark):
    employers = spark.createDataFrame([employer("1", "a", phone="19192222222"), employer("2", "b")], EMPLOYER)
    stored = entity_map(spark, ("1", "1", 0.7, None, False), ("2", "1", 0.7, None, False))
    queue = R.review_queue(stored)
    assert queue.count() == R.review_count(stored).first()[0] == 2
    rows = R.review_rows(queue, stored, employers).orderBy("reviewed_id", "id").collect()
    assert [(r.star, r.score) for r in rows] == [("*", "0.70"), ("", ""), ("", ""), ("*", "0.70")]
    assert {r.first_seen for r in rows} == {"2022-09-30"} and rows[0].phone == "919-222-2222" and rows[0].country == "USA"
    answers = [("1", 1, "n"), ("1", 2, "y"), ("2", 1, "u"), ("2", 2, "x")]
    decisions = spark.createDataFrame(answers, "employer_record_id string, position int, answer string")
    done = R.apply_reviews(stored, decisions, F.lit("2024-01-01").cast("timestamp_ntz"))
    assert {r.employer_record_id: r.is_valid_cluster for r in done.collect()} == {"1": True, "2": None}
    assert done.where("review_date is null").count() == 0 == R.review_count(done).first()[0]
    assert R.invalid_answers(decisions).count() == 1


def test_member_rows_of_large_clusters(spark):
    """One row for each member, whatever the size; the queue has exactly n rows."""
    stored = entity_map(spark, *[(f"{i:04}", "c", 0.7, None, False) for i in range(1500)])
    rows = R.cluster_member_ids(stored).collect()
    assert sorted(r.member_id for r in rows) == [f"{i:04}" for i in range(1500)] and {r.n_members for r in rows} == {1500}
    assert R.review_queue(stored, 7).count() == 7


def test_components_match_union_find(spark):
    random.seed(7)
    edges = [(random.randint(0, 400), random.randint(0, 400)) for _ in range(260)] + [(i, i + 1) for i in range(500, 640)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            ra, rb = find(a), find(b)
            parent[max(ra, rb)] = min(ra, rb)
    df = spark.createDataFrame(edges, "left_id bigint, right_id bigint")
    got = {r.id: r.canon_id for r in C.components(df).collect()}
    assert got == {x: find(x) for x in parent}


def noisy_names(n, seed):
    random.seed(seed)
    names = []
    for _ in range(n):
        base = random.choice(["green acres", "hill farm llc", "sunny valley growers", "oak"])
        text = list(base + random.choice(["", " co", " inc"]))
        for _ in range(random.randint(0, 4)):
            at = random.randrange(len(text))
            text[at : at + 1] = random.choice([[], [random.choice("abxyz")], [text[at], text[at]]])
        names.append("".join(text))
    return names


@pytest.mark.parametrize("similarity", [0.5, 0.76, 0.9])
def test_large_blocks_give_all_pairs_within_reach(spark, similarity):
    names = noisy_names(120, 11)
    rows = spark.createDataFrame([(f"{i:03}", n) for i, n in enumerate(names)], "id string, name string")
    blocks = rows.select(F.lit("one").alias("block_key"), "id")
    got = {tuple(r) for r in P.candidate_pairs(blocks, rows, similarity, max_block=1).collect()}
    plain = {tuple(r) for r in P.candidate_pairs(blocks, rows, similarity, max_block=1000).collect()}
    wanted = set()
    for (i, a), (j, b) in itertools.combinations(enumerate(n.lower().strip() for n in names), 2):
        if a and b and distance(a, b) <= int((1 - similarity) * max(len(a), len(b)) + 1e-9):
            wanted.add((f"{i:03}", f"{j:03}"))
    assert got == plain == wanted


def test_copies_count_as_if_all_pairs_were_scored(spark):
    rows = [employer(f"{i:02}", "green acres farm", phone="19195550000") for i in range(6)]
    rows += [employer(f"{i:02}", "green acre farm", phone="19195550000") for i in range(6, 9)]
    rows += [employer("90", "quite another name", city="Elsewhere", phone="18005550000")]
    df = spark.createDataFrame(rows, EMPLOYER)
    rules = (B.Rule("phone", (B.Part("phone"),)),)
    pairs = P.candidate_pairs(B.block_keys(df, rules), df)
    scored = P.score_pairs(P.compare_pairs(P.pair_records(pairs, df)))
    wanted = C.cluster_scores(C.cluster_pairs(scored), scored)

    def cells(table):
        return sorted((r.employer_record_id, r.canon_id, round(r.cluster_score, 9)) for r in table.collect())

    assert cells(link_records(df, rules)) == cells(wanted) and wanted.count() == 9


def varied_employers(n, seed):
    random.seed(seed)
    names = noisy_names(n, seed)
    rows = []
    for i, name in enumerate(names):
        city = random.choice(["Ames", "Boone", None])
        phone = random.choice([None, "19195550001", f"1919555{i:04}"])
        trade = random.choice([None, "", "acres", f"trade {i}"])
        rows.append(employer(f"{i:03}", name, trade, city, phone))
    return rows


def test_variants_give_the_clusters_of_all_pairs(spark):
    df = spark.createDataFrame(varied_employers(150, 23), EMPLOYER)
    # The phone alone, so that records with one phone meet whatever their names start with.
    rules = (B.Rule("phone", (B.Part("phone"),)), B.Rule("place", (B.Part("city"), B.Part("state"))))

    def clusters(table):
        return sorted((r.employer_record_id, r.canon_id) for r in table.collect())

    every = link_records(df, rules, same=None)
    assert clusters(link_records(df, rules)) == clusters(every)
    assert clusters(link_records(df, rules, max_block=2)) == clusters(every)


def scores(table):
    return sorted((r.employer_record_id, r.canon_id, round(r.cluster_score, 9)) for r in table.collect())


def test_units_give_the_scores_of_all_pairs(spark):
    df = spark.createDataFrame(varied_employers(150, 29), EMPLOYER)
    every = scores(link_records(df, same=None))
    assert scores(link_records(df)) == every
    assert scores(link_records(df, max_block=2)) == every


def test_a_record_near_one_member_is_kept(spark):
    rows = [
        employer("1", "greenfield acres farming", "zzz", phone="19195550001"),
        employer("2", "greenfield acres farming", "valley growers", phone="19195550002"),
        employer("3", "greenfield acre farming", "valley grower", phone="19195550003"),
    ]
    df = spark.createDataFrame(rows, EMPLOYER)
    assert len(scores(link_records(df))) == 3 and scores(link_records(df)) == scores(link_records(df, same=None))


def test_four_alike_have_the_scores_of_all_pairs(spark):
    rows = [employer(str(i), "green acres farm", f"trade {'abcd'[i]} {i * 7}", phone=f"1919555000{i}") for i in range(4)]
    df = spark.createDataFrame(rows, EMPLOYER)
    assert scores(link_records(df)) == scores(link_records(df, same=None))


def test_a_hot_group_is_linked_without_its_pairs(spark, monkeypatch):
    """4,000 records of one name, city and state with 40 trades: profiles are compared, no pair of records is made."""
    rows = [employer(f"{i:05}", "unknown", f"trade {i % 40}", "Nowhere", f"1919{i % 900:07}") for i in range(4000)]
    df = spark.createDataFrame(rows, EMPLOYER)
    made = []
    real = P.pair_records

    def counted(pairs, records, *more):
        made.append(pairs.count())
        return real(pairs, records, *more)

    monkeypatch.setattr(P, "pair_records", counted)
    out = link_records(df)
    assert out.count() == 4000 and out.select("canon_id").distinct().count() == 1
    assert sum(made) == 0
    few = spark.createDataFrame(rows[:300], EMPLOYER)
    assert scores(link_records(few)) == scores(link_records(few, same=None))
    with pytest.raises(ValueError):
        link_records(df, same=["name"])


def test_no_doubtful_pair_is_kept_from_the_labels(spark):
    """Every pair of a block that scores 0.4 to 0.6 is offered for labelling."""
    rows = varied_employers(120, 31)
    rows += [
        employer("x1", "greenfield acres farming llc", phone="19195550001"),
        employer("x2", "greenfield llc acres farming", phone="19195550001"),
    ]
    df = spark.createDataFrame(rows, EMPLOYER)
    blocks = B.block_keys(df)
    met = blocks.alias("a").join(blocks.alias("b"), "block_key").where("a.id < b.id")
    every = met.selectExpr("a.id as left_id", "b.id as right_id").distinct()
    scored = P.score_pairs(P.compare_pairs(P.pair_records(every, df)))
    doubtful = {(r.left_id, r.right_id) for r in scored.where("score >= 0.4 and score <= 0.6").collect()}
    offered = {(r.left_id, r.right_id) for r in L.label_candidates(blocks, df).collect()}
    assert ("x1", "x2") in doubtful and doubtful <= offered


def test_least_name_similarity_is_necessary(spark):
    least = P.least_name_similarity()
    best = {f: 1.0 for f in P.FEATURES} | {"name_sim": least - 1e-6, "trade_missing": 1.0}
    total = P.DEFAULT_WEIGHTS["bias"] + sum(P.DEFAULT_WEIGHTS[f] * v for f, v in best.items())
    assert total < 0.4055
    with pytest.raises(ValueError):
        P.least_name_similarity(P.DEFAULT_WEIGHTS | {"name_sim": 0.0})


def test_entity_map_keeps_reviews(spark):
    scores = spark.createDataFrame([("1", "1", 0.95), ("3", "1", 0.9)], "employer_record_id string, canon_id string, cluster_score double")
    old = entity_map(spark, ("1", "9", 0.7, True, True), ("2", "9", 0.7, False, False))
    kept = {r.employer_record_id: r for r in C.build_entity_map(scores, old).collect()}
    assert (kept["1"].canon_id, kept["1"].is_valid_cluster, kept["1"].processed) == ("1", True, True)
    assert kept["2"].canon_id == "9" and kept["3"].processed is False
    assert C.build_entity_map(scores, old, refresh=True).count() == 2
    assert IDENTITY[0] == "name"
