"""The warehouse's standardization, bucketing and derivation rules as data.

Each public function returns a Column; the builders in ``strata.plans`` only
compose them.  Rule tables below are fixed values that the conformed layer
must reproduce exactly.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .rules import Flag, Membership, Ranges, Rule, Substring, ident, indicator_sum, norm_title, sql_lit, upper_sql

# ---------------------------------------------------------------------------
# Labels and matching rules of the conformed dimensions.
# ---------------------------------------------------------------------------
NOT_AVAILABLE = "n/a"

GENDER = Membership(
    (("Male", ("M", "MALE", "MAN")), ("Female", ("F", "FEMALE", "WOMAN"))),
    default=NOT_AVAILABLE,
    normalize="upper",
)

MARITAL_STATUS = Membership(
    (("Married", ("Yes", "Y", "Married")), ("Single", ("No", "N", "Single"))),
    default=NOT_AVAILABLE,
    normalize="title",
)

CUSTOMER_STATUS = Membership(
    (
        ("Churned", ("Churned", "Churn")),
        ("Active", ("Stayed", "Stay", "Active", "Retained")),
        ("New", ("Joined", "New")),
    ),
    default=NOT_AVAILABLE,
    normalize="title",
)

CONTRACT = Substring(
    (("MONTH", "Month-to-month"), ("ONE", "One year"), ("TWO", "Two year")),
    default="Month-to-month",
)

PAYMENT_METHOD = Substring(
    (
        ("BANK", "Bank transfer"),
        ("CREDIT", "Credit card"),
        ("ELECTRONIC", "Electronic check"),
        ("MAIL", "Mailed check"),
    ),
    default="Unknown",
)

OFFER = Substring(
    (
        ("OFFER A", "Offer A"),
        ("OFFER B", "Offer B"),
        ("OFFER C", "Offer C"),
        ("OFFER D", "Offer D"),
        ("OFFER E", "Offer E"),
    ),
    default="None",  # NULL, '' and any other text
)

PHONE_SERVICE = Flag(default=NOT_AVAILABLE)
MULTIPLE_LINES = Flag(default="No phone service")
REFERRED_A_FRIEND = Flag(default="No")
ADD_ON = Flag(default="Not applicable")

# add-on output column <- raw input column
ADD_ON_COLUMNS = (
    ("online_security", "online_security"),
    ("online_backup", "online_backup"),
    ("device_protection", "device_protection_plan"),
    ("tech_support", "premium_tech_support"),
    ("streaming_tv", "streaming_tv"),
    ("streaming_movies", "streaming_movies"),
    ("streaming_music", "streaming_music"),
    ("unlimited_data", "unlimited_data"),
)
ADD_ONS = tuple(out for out, _ in ADD_ON_COLUMNS)

AGE_GROUP = Ranges(
    (
        (None, 25, "18-24"),
        (25, 35, "25-34"),
        (35, 45, "35-44"),
        (45, 55, "45-54"),
        (55, 65, "55-64"),
        (65, None, "65+"),
    ),
    default=None,
)

POPULATION_DENSITY = Ranges(
    ((75000, None, "Urban"), (20000, None, "Suburban")),
    default="Rural",
)

SERVICE_TIER_BASIC = 0
SERVICE_TIER_STANDARD = (1, 2)

INTERNET_TYPES = ("DSL", "Fiber optic")

# ---------------------------------------------------------------------------
# Column builders (column names in, one Column out)
# ---------------------------------------------------------------------------


def gender(c: str = "gender") -> Column:
    return GENDER.apply(c)


def marital_status(c: str = "married") -> Column:
    return MARITAL_STATUS.apply(c)


def customer_status(c: str = "customer_status") -> Column:
    return CUSTOMER_STATUS.apply(c)


def age_group(c: str = "age") -> Column:
    return AGE_GROUP.apply(c)


def population_density(c: str = "population") -> Column:
    return POPULATION_DENSITY.apply(c)


def service_tier(total: str = "total_services") -> Column:
    t = ident(total)
    low, high = SERVICE_TIER_STANDARD
    return Rule(((f"{t} = {SERVICE_TIER_BASIC}", "Basic"), (f"{t} BETWEEN {low} AND {high}", "Standard")),
                "Premium").apply()


def internet_service(service: str = "internet_service", kind: str = "internet_type",
                     prefer_type: bool = False) -> Column:
    """Internet service label from the service flag and the connection type.

    As coded in the source layer, a YES flag wins before the type is looked at
    (``prefer_type=False``).  ``prefer_type=True`` gives the documented intent:
    a recognised type wins, then YES/NO.
    """
    s, k = upper_sql(ident(service)), upper_sql(ident(kind))
    by_type = [(f"{k} = 'DSL'", "DSL"), (f"contains({k}, 'FIBER')", "Fiber optic")]
    by_flag = [(f"{s} = 'YES'", "Yes"), (f"{s} = 'NO'", "None")]
    cases = by_type + by_flag if prefer_type else by_flag + by_type
    return Rule(tuple(cases), "None").apply()


def bundle_type(phone: str = "phone_service", internet: str = "internet_service") -> Column:
    p, i = ident(phone), ident(internet)
    has_net = f"{i} IN ({', '.join(sql_lit(t) for t in INTERNET_TYPES)})"
    return Rule(
        (
            (f"{p} = 'Yes' AND {has_net}", "Double play"),
            (f"{p} = 'Yes' AND {i} = 'None'", "Single service"),
            (f"{p} = 'No' AND {has_net}", "Single service"),
        ),
        "No service",
    ).apply()


def family_size(marital: str = "marital_status", dependents: str = "number_of_dependents") -> Column:
    d = ident(dependents)
    return F.expr(f"CASE WHEN {ident(marital)} = 'Married' THEN try_add({d}, 2) ELSE try_add({d}, 1) END")


def total_services(cols=ADD_ONS) -> Column:
    return indicator_sum(cols, "Yes")


def churn_detail(status: str, detail: str) -> Column:
    """Detail kept only for churned customers (NULL -> n/a); n/a otherwise; '' survives."""
    na = sql_lit(NOT_AVAILABLE)
    return F.expr(f"CASE WHEN {ident(status)} = 'Churned' THEN coalesce({ident(detail)}, {na}) ELSE {na} END")


def title_case(c: str) -> Column:
    """Title case without outer spaces (``initcap`` splits words on spaces only,
    so trimming before or after it gives the same text)."""
    return norm_title(c)


def zip5(c: str) -> Column:
    """ZIP as 5 characters: left-padded with zeros; longer input is cut to 5."""
    return F.expr(f"lpad(trim(CAST({ident(c)} AS STRING)), 5, '0')")


def round_coordinate(c: str, digits: int = 4) -> Column:
    return F.expr(f"round(try_cast({ident(c)} AS DOUBLE), {int(digits)})")


def clean_count(c: str) -> Column:
    """Numeric text to INT: strip all but digits and dots; '' -> 0; unparsable or NULL -> NULL.

    Parsing goes through DOUBLE (so ``'20000.0'`` is 20000) and truncates; every
    cast is a ``try_cast`` so bad text gives NULL under ANSI mode too.
    """
    digits = f"regexp_replace({ident(c)}, '[^0-9.]', '')"
    return F.expr(f"CASE WHEN {digits} = '' THEN 0 ELSE try_cast(try_cast({digits} AS DOUBLE) AS INT) END")


def quarter_of_year(c: str = "quarter") -> Column:
    return F.expr(f"try_cast(regexp_extract({ident(c)}, 'Q(\\\\d)', 1) AS INT)")


def half_of_year(q: str = "quarter_of_year") -> Column:
    return F.expr(f"CASE WHEN {ident(q)} <= 2 THEN 'H1' ELSE 'H2' END")
