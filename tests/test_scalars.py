import pytest
from pyspark.sql import functions as F

from reclink.functions import payload as P
from reclink.functions import text as X
from reclink.functions.distance import gap_costs, levenshtein_ratio
from reclink.operators.clean import clean_address, clean_disclosure, clean_listing, reclean

USA = X.USA


def text(value):
    return F.lit(value).cast("string")


@pytest.mark.parametrize(
    ("given", "wanted"),
    [
        (" Test business ", "Test business"),
        ("a   b", "a b"),
        ("a\n\nb", "a  b"),
        ("\t padded \n", "padded"),
        ('"quoted"', "quoted"),
        ("\"'both'\"", "both"),
        ("n/A", None),
        ("", None),
        (None, None),
        ('""', None),
        (" x ", "x"),
        ("n/a b", "n/a b"),
    ],
)
def test_clean_string(one, given, wanted):
    assert one(X.clean_string(text(given))) == wanted


@pytest.mark.parametrize(
    ("given", "country", "wanted"),
    [
        ("1-919-222+2222", USA, "19192222222"),
        ("919-222+2222", None, "19192222222"),
        ("919-222+2222", "CANADA", "9192222222"),
        ("1-919-222A", USA, "1919222"),
        ("none", None, None),
        (None, None, None),
    ],
)
def test_clean_phone(one, given, country, wanted):
    assert one(X.clean_phone(text(given), text(country))) == wanted


@pytest.mark.parametrize(
    ("given", "wanted"),
    [
        ("DBA test business ", "test business"),
        ("d/b/a x", "x"),
        ("dba: x", "x"),
        ("Dba x", "Dba x"),
        (" DBA x", "DBA x"),
        ("DBA DBA x", "DBA x"),
    ],
)
def test_strip_dba(one, given, wanted):
    assert one(X.clean_string(X.strip_dba(text(given)))) == wanted


def test_state_and_country(one):
    assert one(X.state_abbrev(text("California"))) == "CA"
    assert one(X.state_abbrev(text("u.s. VIRGIN islands"))) == "VI"
    assert one(X.state_abbrev(text("Ontario"))) == "Ontario"
    assert one(X.state_abbrev(text(None))) is None
    assert one(X.default_country(text(None), text("ca"))) == USA
    assert one(X.default_country(text(None), text("Ontario"))) is None
    assert one(X.default_country(text("CANADA"), text("CA"))) == "CANADA"
    assert one(X.default_country(text(None), text("CA,NC"))) is None
    assert len(X.STATES) == 57


@pytest.mark.parametrize("given", ["o'neil 1st mckinley-smith", "ÉCOLE d'été\tno.5b", "a  b", "", "x1y2 3z", "ßa über-x"])
def test_title_case(one, given):
    assert one(X.title_case(text(given))) == given.title()


def test_format_address(one):
    full = [text(v) for v in ("Address line 1", "Address line 2", "City", "NC", "27701", "USA")]
    assert one(X.format_address(*full)) == "Address line 1 Address line 2, City, NC 27701 USA"
    part = [text(v) for v in ("Address line 1", "Address line 2", None, "", None, "USA")]
    assert one(X.format_address(*part)) == "Address line 1 Address line 2 USA"
    other = [text("Another line"), *full[1:]]
    assert one(X.address_hash(*full)) != one(X.address_hash(*other))
    assert not one(X.address_is_null(*full))
    assert one(X.address_is_null(*[text(None)] * 6))


def test_clean_address(spark):
    columns = "address_1 string, address_2 string, city string, state string, postal_code string, country string"
    rows = [(" Address LINE 1 ", " address line 2  ", None, "north carolina", "27701 ", None)]
    row = clean_address(spark.createDataFrame(rows, columns)).first()
    assert row[:6] == ("Address Line 1", "Address Line 2", None, "NC", "27701", USA)
    assert row["normalized_address"] == "Address Line 1 Address Line 2, Nc 27701 United States Of America"


@pytest.mark.parametrize(
    ("given", "wanted"),
    [
        (None, ""),
        ("+1 (919) 222-2222", "919-222-2222"),
        ("19192222222", "919-222-2222"),
        ("12345", "2345"),
        ("+44 20", "4420"),
    ],
)
def test_format_phone(one, given, wanted):
    assert one(X.format_phone(text(given))) == wanted


def test_slugify(one):
    assert one(X.slugify(text("Ñandú & Sons--"))) == "nandu-sons"
    assert one(X.slugify(text("--Straße_Ærø"))) == "-strasse_aero"
    assert one(X.slugify(text(None))) is None


def test_visa_class(one):
    assert one(X.visa_class(text("x/H-2A_2020.csv"))) == "H-2A"
    assert one(X.visa_class(text("h-2b.csv"))) == "H-2B"
    assert one(X.visa_class(text("h-2b_H-2A.csv"))) is None
    assert one(X.visa_class(text("perm.csv"))) is None


def test_payload_rules(one):
    import json

    def fixed(body):
        return json.loads(one(P.fix_apply_url(text(json.dumps(body)))))

    assert fixed({"apply_url": "N/A", "n": 1}) == {"apply_url": "", "n": 1}
    assert fixed({"apply_url": "https://http:www.twc.state.tx.us", "v": {"a": [1]}}) == {
        "apply_url": "https://www.twc.state.tx.us",
        "v": {"a": [1]},
    }
    assert fixed({"apply_url": "https://test.com"}) == {"apply_url": "https://test.com"}
    assert fixed({"other": "N/A"}) == {"other": "N/A"}


def test_clean_listing_keeps_rows_without_payload(spark):
    columns = (
        "dol_id string, scraped_data string, employer_name string, trade_name_dba string, employer_city string, "
        "employer_state string, employer_postal_code string, employer_phone string, employer_country string"
    )
    body = '{"employer_business_name":" Test ","employer_trade_name":"","employer_state":"California","employer_phone":"1-919-222A"}'
    rows = [("H-1", body, None, "old", "x", None, None, None, USA), ("H-2", "{}", " raw ", None, None, None, None, "1", USA)]
    first, second = clean_listing(spark.createDataFrame(rows, columns)).orderBy("dol_id").collect()
    assert (first.employer_name, first.trade_name_dba, first.employer_city) == ("Test", None, None)
    assert (first.employer_state, first.employer_phone) == ("CA", "1919222")
    assert second.employer_name == " raw "


def test_reclean_reports_rows_that_still_change(spark):
    columns = ", ".join(
        f"{c} string"
        for c in (
            "id employer_name trade_name_dba employer_address_1 employer_address_2 employer_city employer_state "
            "employer_country employer_postal_code employer_phone phone_to_apply"
        ).split()
    )
    rows = [("1", "a", "DBA DBA x") + (None,) * 8, ("2", "a", "DBA x") + (None,) * 8]
    once, unsettled = reclean(spark.createDataFrame(rows, columns))
    assert sorted((r.id, r.trade_name_dba) for r in once.collect()) == [("1", "DBA x"), ("2", "x")]
    assert [(r.id, r.trade_name_dba) for r in unsettled.collect()] == [("1", "DBA x")]
    assert clean_disclosure(once).where("trade_name_dba = 'x'").count() == 2


def plain_gap(a, b):
    """Affine gap by the textbook recurrences, cell by cell."""
    if a == b:
        return len(a) / (2 * len(a))
    if len(a) < len(b):
        a, b = b, a
    inf = float("inf")
    best = [[0.0] * (len(a) + 1) for _ in range(len(b) + 1)]
    down = [[inf] * (len(a) + 1) for _ in range(len(b) + 1)]
    for j in range(1, len(a) + 1):
        best[0][j] = 10 + 7 * j
    for i in range(1, len(b) + 1):
        best[i][0] = 10 + 7 * i
        across = inf
        for j in range(1, len(a) + 1):
            share = 1 if j <= len(b) else 0.125
            across = min(across, best[i][j - 1] + 10 * share) + 7 * share
            down[i][j] = min(down[i - 1][j], best[i - 1][j] + 10) + 7
            step = best[i - 1][j - 1] + (1 if a[j - 1] == b[i - 1] else 11)
            best[i][j] = min(across, down[i][j], step)
    return best[len(b)][len(a)] / (len(a) + len(b))


def test_affine_gap_matches_the_recurrences():
    import random

    import pandas as pd

    random.seed(5)
    words = ["".join(random.choice("abc ") for _ in range(random.randint(1, 9))) for _ in range(80)]
    left, right = words[:40], words[40:]
    got = gap_costs(pd.Series(left), pd.Series(right))
    assert [round(v, 9) for v in got] == [round(plain_gap(a, b), 9) for a, b in zip(left, right)]
    assert gap_costs(pd.Series(["", None]), pd.Series(["a", "b"])).isna().all()


def test_levenshtein_ratio(one):
    assert one(levenshtein_ratio(text("kitten"), text("sitting"))) == pytest.approx(1 - 3 / 7)
    assert one(levenshtein_ratio(text(None), text("x"))) is None


def test_gap_costs_in_slices(monkeypatch):
    """A long text among short ones changes no cost, and no array is wider than a slice."""
    import random

    import pandas as pd

    from reclink.functions import distance

    chooser = random.Random(4)
    texts = ["".join(chooser.choice("abc ") for _ in range(chooser.randrange(0, 12))) for _ in range(60)] + ["ab" * 150]
    left, right = pd.Series(texts), pd.Series(texts[::-1])
    whole = distance.gap_costs(left, right)
    widest = []
    real = distance._codes
    monkeypatch.setattr(distance, "AREA", 64)
    monkeypatch.setattr(distance, "_codes", lambda t, w: widest.append(len(t) * w) or real(t, w))
    pd.testing.assert_series_equal(distance.gap_costs(left, right), whole)
    assert max(widest) <= 300
    one = distance.gap_costs(left[:1], right[:1])
    assert one.isna().all() or one[0] == whole[0]
