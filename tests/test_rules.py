"""Unit cells for every standardization / bucketing / derivation rule."""

from pyspark.sql import functions as F

from strata.functions import standard as std


def one_col(spark, values, typ="string"):
    return spark.createDataFrame([(v,) for v in values], f"x {typ}")


def mapped(spark, values, fn, typ="string"):
    df = one_col(spark, values, typ)
    return {r[0]: r[1] for r in df.select("x", fn("x").alias("y")).collect()}


def test_gender(spark):
    m = mapped(spark, ["Male", "female", " m ", "F", "woman", "MAN", "x", "", None, "\tm"], std.gender)
    assert m["Male"] == "Male" and m[" m "] == "Male" and m["MAN"] == "Male"
    assert m["female"] == "Female" and m["F"] == "Female" and m["woman"] == "Female"
    assert m["x"] == "n/a" and m[""] == "n/a" and m[None] == "n/a"
    assert m["\tm"] == "n/a"  # trim strips spaces only


def test_marital_status(spark):
    m = mapped(spark, ["Yes", "no", " y ", "N", "single", "MARRIED", "maybe", None], std.marital_status)
    assert [m[k] for k in ["Yes", " y ", "MARRIED"]] == ["Married"] * 3
    assert [m[k] for k in ["no", "N", "single"]] == ["Single"] * 3
    assert m["maybe"] == "n/a" and m[None] == "n/a"


def test_customer_status(spark):
    m = mapped(spark, ["Stayed", "churned", " JOINED", "Churn", "retained", "active", "new ", "zzz", None],
               std.customer_status)
    assert m["churned"] == m["Churn"] == "Churned"
    assert m["Stayed"] == m["retained"] == m["active"] == "Active"
    assert m[" JOINED"] == m["new "] == "New"
    assert m["zzz"] == m[None] == "n/a"


def test_flags(spark):
    df = one_col(spark, ["Yes", " no", "YES ", "No", "maybe", "", None])
    out = {r[0]: (r[1], r[2], r[3], r[4]) for r in df.select(
        "x", std.PHONE_SERVICE.apply("x"), std.MULTIPLE_LINES.apply("x"),
        std.ADD_ON.apply("x"), std.REFERRED_A_FRIEND.apply("x")).collect()}
    assert out["Yes"] == out["YES "] == ("Yes", "Yes", "Yes", "Yes")
    assert out[" no"] == out["No"] == ("No", "No", "No", "No")
    for k in ["maybe", "", None]:
        assert out[k] == ("n/a", "No phone service", "Not applicable", "No")


def test_substring_rules(spark):
    c = mapped(spark, ["Month-to-Month", "one year", "Two Year", "none", None, "weekly"], std.CONTRACT.apply)
    assert c["Month-to-Month"] == "Month-to-month" and c["one year"] == "One year" and c["Two Year"] == "Two year"
    assert c["none"] == "One year"  # over-match kept: 'NONE' contains 'ONE'
    assert c[None] == "Month-to-month" and c["weekly"] == "Month-to-month"
    p = mapped(spark, ["Bank Withdrawal", "credit card", "Electronic Check", "mailed check", "cash", None],
               std.PAYMENT_METHOD.apply)
    assert list(p.values()) == ["Bank transfer", "Credit card", "Electronic check", "Mailed check", "Unknown", "Unknown"]
    o = mapped(spark, ["Offer A", "offer b", " OFFER C ", "None", "", "Offer Extra", None, "Offer AB"], std.OFFER.apply)
    assert o["Offer A"] == "Offer A" and o["offer b"] == "Offer B" and o[" OFFER C "] == "Offer C"
    assert o["Offer Extra"] == "Offer E" and o["Offer AB"] == "Offer A"
    assert o["None"] == o[""] == o[None] == "None"


def test_internet_service(spark):
    df = spark.createDataFrame(
        [("Yes", "DSL"), ("No", "DSL"), (None, "DSL"), (None, "Fiber Optic"), (None, "fiber-x"), (None, "Cable"),
         ("maybe", None)],
        "s string, t string",
    )
    got = [tuple(r) for r in df.select(std.internet_service("s", "t"), std.internet_service("s", "t", True)).collect()]
    assert got == [("Yes", "DSL"), ("None", "DSL"), ("DSL", "DSL"), ("Fiber optic", "Fiber optic"),
                   ("Fiber optic", "Fiber optic"), ("None", "None"), ("None", "None")]


def test_age_group(spark):
    ages = [24, 25, 34, 35, 44, 45, 54, 55, 64, 65, -3, None]
    m = mapped(spark, ages, std.age_group, "int")
    assert [m[a] for a in ages] == ["18-24", "25-34", "25-34", "35-44", "35-44", "45-54", "45-54", "55-64", "55-64",
                                    "65+", "18-24", None]


def test_population_density(spark):
    vals = [None, 0, 19999, 20000, 74999, 75000]
    m = mapped(spark, vals, std.population_density, "int")
    assert [m[v] for v in vals] == ["Rural", "Rural", "Rural", "Suburban", "Suburban", "Urban"]


def test_service_tier_and_bundle(spark):
    m = mapped(spark, [0, 1, 2, 3, 8], std.service_tier, "int")
    assert [m[v] for v in [0, 1, 2, 3, 8]] == ["Basic", "Standard", "Standard", "Premium", "Premium"]
    df = spark.createDataFrame(
        [("Yes", "DSL"), ("Yes", "Fiber optic"), ("Yes", "None"), ("No", "DSL"), ("No", "None"), ("Yes", "Yes"),
         ("n/a", "DSL")],
        "p string, i string",
    )
    got = [r[0] for r in df.select(std.bundle_type("p", "i")).collect()]
    assert got == ["Double play", "Double play", "Single service", "Single service", "No service", "No service",
                   "No service"]


def test_family_size_and_total(spark):
    df = spark.createDataFrame([("Married", 2), ("Single", 2), ("n/a", 0), ("Married", None)], "m string, d int")
    assert [r[0] for r in df.select(std.family_size("m", "d")).collect()] == [4, 3, 1, None]
    flags = spark.createDataFrame([("Yes", "No", None, "Yes")], "a string, b string, c string, d string")
    assert flags.select(std.total_services(["a", "b", "c", "d"])).first()[0] == 2


def test_clean_count(spark):
    vals = ["", "N/A", "1.2.3", "105,285", "19999", "20000.0", "99999999999", None, "678"]
    m = mapped(spark, vals, std.clean_count)
    assert m[""] == 0 and m["N/A"] == 0  # everything stripped -> ''
    assert m["1.2.3"] is None and m["105,285"] == 105285 and m["19999"] == 19999
    assert m["20000.0"] == 20000 and m["99999999999"] is None and m[None] is None and m["678"] == 678


def test_zip_coordinates_quarter(spark):
    z = mapped(spark, [90, 90001, 123456789, None], std.zip5, "int")
    assert z[90] == "00090" and z[90001] == "90001" and z[123456789] == "12345" and z[None] is None
    q = mapped(spark, ["Q3", "q3", "Qx", "Q12", None], std.quarter_of_year)
    assert q["Q3"] == 3 and q["q3"] is None and q["Qx"] is None and q["Q12"] == 1 and q[None] is None
    h = mapped(spark, [1, 2, 3, None], std.half_of_year, "int")
    assert [h[k] for k in [1, 2, 3, None]] == ["H1", "H1", "H2", "H2"]
    c = mapped(spark, ["o'brien-smith", " los angeles", "SAN JOSE"], std.title_case)
    assert c["o'brien-smith"] == "O'brien-smith" and c[" los angeles"] == "Los Angeles" and c["SAN JOSE"] == "San Jose"


def test_rules_idempotent(spark):
    """Standardizing an already standard value gives the same value."""
    df = spark.createDataFrame([("Male", "Married", "Churned", "One year", "Offer B")],
                               "g string, m string, s string, c string, o string")
    r = df.select(std.gender("g"), std.marital_status("m"), std.customer_status("s"),
                  std.CONTRACT.apply("c"), std.OFFER.apply("o")).first()
    assert tuple(r) == ("Male", "Married", "Churned", "One year", "Offer B")


def test_coordinate_range_boundaries(spark):
    from strata.plans.dimensions import clean_location, valid_coordinates

    df = spark.createDataFrame(
        [("a", 1, -90.0, 0.0), ("b", 2, 90.0, 180.0), ("c", 3, 90.0001, 0.0), ("d", 4, None, 0.0),
         ("e", 5, 0.0, -180.00004), ("f", 6, 0.0, -180.00005)],
        "city string, zip_code int, latitude double, longitude double",
    )
    kept = sorted(r.city for r in valid_coordinates(clean_location(df)).collect())
    # rounding to 4 decimals happens first: -180.00004 -> -180.0 (kept), -180.00005 -> -180.0001 (dropped)
    assert kept == ["A", "B", "E"]


def test_internet_type_preference_makes_double_play_reachable(spark, sf_smoke):
    """T4: as coded, a customer whose internet flag is YES gets internet 'Yes',
    so never 'Double play'; preferring the connection type makes it reachable."""
    from pyspark.sql import functions as F

    from strata.plans import dimensions as dims
    from strata.sources.raw_views import raw_view

    yes_flag = raw_view(spark, sf_smoke, "services").filter(F.trim(F.upper("internet_service")) == "YES")

    def bundles(prefer):
        pkg = dims.derive_package(dims.standardize_services(yes_flag, prefer))
        return {r[0] for r in pkg.select("bundle_type").distinct().collect()}

    assert "Double play" not in bundles(False)
    assert "Double play" in bundles(True)
