import datetime as dt
import random
import unicodedata

import pytest

from rollbook.config import Settings
from rollbook.functions import similarity, text, values

SETTINGS = Settings(as_of=dt.date(2024, 12, 31))


def test_person_name(evaluate):
    cases = {
        "jean-luc o'brien": "Jean-Luc O'Brien",
        "3rd": "3Rd",
        "x_y": "X_Y",
        "  mary  ANN ": "Mary  Ann",
        " élodie　": "Élodie",
        "Ａlice": "Alice",
        "ﬁona": "Fiona",
        "straße": "Straße",
        "   ": None,
        "": None,
        None: None,
    }
    assert evaluate(text.person_name("v"), list(cases)) == list(cases.values())


def test_person_name_equals_python_for_all_letters(spark, evaluate):
    """NFKC, strip and title case of every assigned letter and mark of the basic plane."""
    rows = []
    for code in range(0x80, 0x10000):
        char = chr(code)
        if unicodedata.category(char)[0] in "LMNPSZ":
            rows += [char + "a", "a" + char + "B " + char]
    expected = [unicodedata.normalize("NFKC", r).strip().title() or None for r in rows]
    found = evaluate(text.person_name("v"), rows)
    wrong = [(r, f, e) for r, f, e in zip(rows, found, expected) if f != e]
    # letters whose case pairs are newer than the Unicode tables of the Java runtime
    assert len(wrong) < 60, wrong[:20]
    recent = [w for w in wrong if not ("Ⱟ" <= max(w[0]) or w[0][0] in "ƛɤ" or "ƛ" in w[0])]
    assert len(recent) < 10, recent[:10]


def test_full_name(evaluate):
    rows = [("A", "B"), ("A", None), (None, "B"), (None, None)]
    found = evaluate(text.full_name("a", "b"), rows, "a string, b string")
    assert found == ["A B", "A", "B", None]


def test_email(evaluate):
    assert evaluate(text.strip_lower("v"), ["\t A@B.Com \n", "", None]) == ["a@b.com", "", None]


def test_employee_key(evaluate):
    cases = {
        ("1", "GlobalTech"): "GT-000001",
        ("1042", "GlobalTech"): "GT-001042",
        ("ACQ_00001", "AcquiredCo"): "AC-000001",
        ("ACQ_01042", " AcquiredCo "): "AC-001042",
        ("123.0", "GlobalTech"): "GT-000123",
        ("123.7", "GlobalTech"): "GT-000123",
        (" 7. ", "GlobalTech"): "GT-000007",
        (".5", "GlobalTech"): "GT-000000",
        (".5x", "GlobalTech"): "GT-000005",
        ("0", "GlobalTech"): "GT-000000",
        ("1234567", "GlobalTech"): "GT-1234567",
        ("12-34", "GlobalTech"): "GT-000012",
        ("x", "GlobalTech"): None,
        ("", "GlobalTech"): None,
        ("1", "Other"): None,
        (None, "GlobalTech"): None,
        ("1", None): None,
    }
    found = evaluate(values.employee_key("v", "c"), list(cases), "v string, c string")
    assert found == list(cases.values())


def test_employment_type(evaluate):
    cases = {
        " FT ": "Full-Time", "full time": "Full-Time", "PART TIME": "Part-Time", "pt": "Part-Time",
        "contract": "Contractor", "CT": "Contractor", "intern": None, "": None, None: None,
    }
    assert evaluate(values.employment_type("v"), list(cases)) == list(cases.values())


DATES = {
    "2020-01-05": dt.datetime(2020, 1, 5),
    " 2020-01-05 10:30:00 ": dt.datetime(2020, 1, 5, 10, 30),
    "2020-01-05T23:30:00-05:00": dt.datetime(2020, 1, 6, 4, 30),
    "2020-01-05T00:00:00Z": dt.datetime(2020, 1, 5),
    "2020-01-05T10:00:00+0200": dt.datetime(2020, 1, 5, 8),
    "20200105": dt.datetime(2020, 1, 5),
    "2020/1/5": dt.datetime(2020, 1, 5),
    "01/05/2020": dt.datetime(2020, 1, 5),
    "25/12/2020": dt.datetime(2020, 12, 25),
    "5-Jan-2020": dt.datetime(2020, 1, 5),
    "Jan 5, 2020": dt.datetime(2020, 1, 5),
    "January 5, 2020": dt.datetime(2020, 1, 5),
    "5 January 2020": dt.datetime(2020, 1, 5),
    "1970-01-01": dt.datetime(1970, 1, 1),
    "1969-12-31": None,
    "2024-12-31": dt.datetime(2024, 12, 31),
    "2024-12-31 00:00:01": None,
    "2999-01-01": None,
    "2020-02-30": None,
    "junk": None,
    "12:30": None,
    "": None,
    None: None,
}


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Tokyo"])
def test_standard_date_in_any_session_zone(spark, evaluate, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        found = evaluate(values.standard_date("v", SETTINGS), list(DATES))
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert dict(zip(DATES, found)) == DATES


def test_salary_amount(evaluate):
    cases = {
        "$85,000": 85000.0, "€1,000.5": 1000.5, " £ 12 ": 12.0, "1e3": 1000.0, "-5": -5.0,
        "85.000,00": 85.0, "abc": None, "85000d": None, "Infinity": None, "": None, None: None,
    }
    assert evaluate(values.salary_amount("v"), list(cases)) == list(cases.values())


def test_salary_usd_annual(evaluate):
    cases = {
        ("1000", "EUR", "Monthly"): 12960.0,
        ("100", "gbp", "bi weekly"): 3302.0,
        ("$85,000", " usd ", " ANNUAL "): 85000.0,
        ("0.125", "USD", "annual"): 0.13,
        ("1", "JPY", "annual"): None,
        ("1", "USD", "weekly"): None,
        ("abc", "USD", "annual"): None,
        (None, "USD", "annual"): None,
        ("1", None, "annual"): None,
        ("1", "USD", None): None,
    }
    found = evaluate(
        values.salary_usd_annual("s", "c", "f"), list(cases), "s string, c string, f string"
    )
    assert found == list(cases.values())


def test_day_gap_floors_before_taking_the_absolute_value(evaluate):
    day = dt.datetime(2020, 3, 8)
    hours = dt.timedelta(hours=12)
    rows = [
        (day, day + hours),
        (day + hours, day),
        (day, day + dt.timedelta(days=30, hours=12)),
        (day + dt.timedelta(days=30, hours=12), day),
        (day, day),
    ]
    found = evaluate(values.day_gap("a", "b"), rows, "a timestamp_ntz, b timestamp_ntz")
    assert found == [1, 0, 31, 30, 0] == [abs((a - b).days) for a, b in rows]


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(new[j], row[j + 1]))
        row = new
    return row[-1]


def score(a, b):
    n = len(a) + len(b)
    return (1 - (n - 2 * lcs(a, b)) / n) * 100


def test_sorted_tokens(evaluate):
    rows = ["  b  a\tC ", "Zed Ann", "one"]
    assert evaluate(text.sorted_tokens("v"), rows) == ["C a b", "Ann Zed", "one"]


def test_lcs_in_one_word_and_in_several(evaluate):
    rng = random.Random(5)
    rows = [
        ("".join(rng.choices("abc é😀", k=rng.choice([rng.randint(1, 90), rng.randint(100, 400)]))),
         "".join(rng.choices("abc é😀", k=rng.choice([rng.randint(1, 90), rng.randint(100, 400)]))))
        for _ in range(150)
    ]
    rows += [("a" * n, "a" * m) for n in (61, 62, 122, 123, 183) for m in (60, 61, 62, 122, 123, 200)]
    rows += [("a", "b"), ("ab", ""), ("", "ab"), ("ab" * 80, ""), ("ab" * 80, "ba" * 80)]
    masks = similarity.character_masks("a")
    found = evaluate(similarity.lcs_length("a", masks, "b"), rows, "a string, b string")
    assert found == [lcs(a, b) for a, b in rows]


def test_known_scores(evaluate):
    rows = [
        ("Gary Phillips", "Larry Phillips"),
        ("Gary Martin", "Gary Martinez"),
        ("Ann Lee", "Lee Ann"),
    ]
    a, b = text.sorted_tokens("a"), text.sorted_tokens("b")
    measured = similarity.lcs_length(a, similarity.character_masks(a), b)
    total = f"length({a}) + length({b})"
    found = evaluate(similarity.score(total, measured), rows, "a string, b string")
    assert [round(x, 4) for x in found] == [88.8889, 91.6667, 100.0]


def test_shapes_follow_from_the_layouts():
    from rollbook.config import DATE_LAYOUTS
    from rollbook.functions.values import shapes

    found = shapes(DATE_LAYOUTS)
    assert found["99/9/9999"] == ["M/d/yyyy", "d/M/yyyy"]
    assert found["99999999"] == ["yyyyMMdd"]
    assert found["aaa 9, 9999"] == ["MMM d, yyyy"]
    assert found["99 aaaaaaaaa 9999"] == ["d MMMM yyyy"] and found["9 aaaa 9999"] == ["d MMMM yyyy"]
    assert "99 aaaaaaaaaa 9999" not in found and "9/9/9999 99:99:99" in found


def test_layouts_are_data(evaluate):
    import datetime as dt

    from rollbook.config import Settings
    from rollbook.functions.values import parsed_date

    own = Settings(date_layouts=("yyyy.MM.dd", "d. MMMM yyyy"))
    rows = ["2020.01.05", "5. March 2021", "01/05/2020", "2020-01-05", "2020.13.01", "", "日本", "2020.01.05 "]
    found = evaluate(parsed_date("v", own), rows)
    assert found == [dt.datetime(2020, 1, 5), dt.datetime(2021, 3, 5), None, dt.datetime(2020, 1, 5), None, None, None, None]
    assert evaluate(parsed_date("v", Settings(date_layouts=())), rows)[:4] == [None, None, None, dt.datetime(2020, 1, 5)]
