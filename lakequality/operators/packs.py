"""Ready rule sets. Each is a function, so formats, domains and the reference time are parameters."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from lakequality.functions import checks as c
from lakequality.operators.rules import ERROR, WARN, Rule, RuleSet, unique

# ---- Fixed values: domains, formats and bounds ------------------------------------------------

WEATHER_SOURCES = ("sensor_simulator", "external_api", "sensor_data")
ORDER_STATUSES = ("NEW", "PROCESSING", "SHIPPED", "DELIVERED", "CANCELLED", "RETURNED")
PAYMENT_STATUSES = ("PENDING", "PAID", "REFUNDED", "FAILED", "PARTIAL")
CATALOG_ORDER_STATUSES = ("NEW", "CONFIRMED", "PROCESSING", "SHIPPED", "DELIVERED", "CANCELLED")
CATALOG_PAYMENT_STATUSES = ("PENDING", "AUTHORIZED", "PAID", "FAILED", "REFUNDED")
CURRENCIES = ("USD", "EUR", "GBP", "CAD", "AUD", "JPY")
PAYMENT_METHODS = ("CREDIT", "DEBIT", "CASH", "CHECK")
OPEN_STATUSES = ("NEW", "PROCESSING", "SHIPPED", "DELIVERED")
ORDER_ID = "^ORD-[0-9]{6}$"
PRODUCT_ID = "^PRD[0-9]{3}$"
# Which payment states may accompany which order states.
STATUS_PAIRS = (
    (("DELIVERED",), ("PAID",)),
    (("CANCELLED",), ("REFUNDED", "FAILED", "PENDING")),
    (("NEW", "PROCESSING", "SHIPPED"), ("PENDING", "PAID")),
    (("RETURNED",), ("REFUNDED",)),
)
# Combinations of order and payment state that the order model rejects.
STATUS_CLASHES = (("CANCELLED", "PAID"), ("DELIVERED", "PENDING"))
WEATHER_BOUNDS = {
    "temperature": (-60, 60),
    "humidity": (0, 100),
    "latitude": (-90, 90),
    "longitude": (-180, 180),
}


def weather_rules(as_of=None, *, criticality: str = ERROR) -> RuleSet:
    """Completeness, type, range, format and time rules for weather readings."""
    time = "weather_timestamp"
    bounds = WEATHER_BOUNDS
    return RuleSet(
        (
            Rule("event_id_not_null", c.not_empty("event_id"), criticality),
            Rule("city_not_null", c.not_empty("city"), criticality),
            Rule("weather_timestamp_not_null", c.not_null(time), criticality),
            *(
                Rule(f"{name}_is_numeric", c.not_null(name), WARN, "high")
                for name in ("temperature", "humidity", "latitude", "longitude")
            ),
            Rule(
                "temperature_realistic_range",
                c.between("temperature", *bounds["temperature"]),
                WARN,
                "medium",
            ),
            Rule(
                "humidity_valid_percentage",
                c.between("humidity", *bounds["humidity"]),
                WARN,
                "medium",
            ),
            Rule("latitude_valid_range", c.between("latitude", *bounds["latitude"]), WARN, "medium"),
            Rule(
                "longitude_valid_range", c.between("longitude", *bounds["longitude"]), WARN, "medium"
            ),
            Rule("city_name_format", c.length_between("city", 2, 50), WARN, "medium"),
            Rule("data_source_valid", c.one_of("data_source", WEATHER_SOURCES), WARN, "medium"),
            Rule("timestamp_not_future", c.not_after(time, as_of)),
        )
    )


def order_critical() -> RuleSet:
    positive = ("quantity", "unit_price", "total_amount")
    required = ("order_id", "product_id", "customer_id", "order_date")
    return RuleSet(
        (
            gross_total_matches(),
            *(Rule(f"{name}_positive", c.greater_than(name, 0)) for name in positive),
            *(Rule(f"{name}_not_null", c.not_empty(name)) for name in required),
            Rule(
                "tax_amount_valid",
                c.share_of("tax_amount", "total_amount", 0.3),
                message="tax is outside 0 to 30 percent of the total",
            ),
        )
    )


def gross_total_matches() -> Rule:
    return Rule(
        "total_amount_calculation_valid",
        c.equals("total_amount", "quantity * unit_price"),
        message="total_amount differs from quantity times unit_price",
    )


def net_total_matches() -> Rule:
    return Rule(
        "net_total_matches",
        c.equals(
            "total_amount",
            "quantity * unit_price - discount_amount + tax_amount + shipping_cost",
        ),
        message="Total amount mismatch",
    )


def order_high(
    order_statuses: Sequence[str] = ORDER_STATUSES,
    payment_statuses: Sequence[str] = PAYMENT_STATUSES,
) -> RuleSet:
    return RuleSet(
        (
            Rule("order_status_valid", c.one_of("order_status", order_statuses), WARN, "high"),
            Rule("payment_status_valid", c.one_of("payment_status", payment_statuses), WARN, "high"),
            Rule(
                "payment_order_status_consistency",
                c.allowed_pairs("order_status", "payment_status", STATUS_PAIRS),
                WARN,
                "high",
                "payment state does not fit the order state",
            ),
            Rule(
                "shipping_address_complete",
                c.length_between("shipping_address", 10),
                WARN,
                "high",
                "shipping address is missing or short",
            ),
        )
    )


def order_medium(order_id: str = ORDER_ID, product_id: str = PRODUCT_ID) -> RuleSet:
    return RuleSet(
        (
            Rule("order_id_format", c.matches("order_id", order_id), WARN, "medium"),
            Rule("product_id_format", c.matches("product_id", product_id), WARN, "medium"),
            Rule("customer_email_format", c.matches("customer_email", c.EMAIL), WARN, "medium"),
        )
    )


def order_low(as_of=None, *, max_quantity=1000, max_price=50000) -> RuleSet:
    return RuleSet(
        (
            Rule("quantity_reasonable_range", c.at_most("quantity", max_quantity), WARN, "low"),
            Rule("unit_price_reasonable_range", c.at_most("unit_price", max_price), WARN, "low"),
            Rule("order_date_not_future", c.not_after("order_date", as_of), WARN, "low"),
            Rule(
                "discount_percentage_valid",
                c.between("discount_percentage", 0, 100),
                WARN,
                "low",
            ),
        )
    )


def order_rules(
    as_of=None,
    *,
    financial: bool = True,
    formats: bool = True,
    ranges: bool = True,
    consistency: bool = True,
) -> RuleSet:
    """The twenty order rules of all four categories; each group can be left out."""
    rules = RuleSet(())
    if financial:
        rules += order_critical()
    if consistency:
        rules += order_high()
    if formats:
        rules += order_medium()
    if ranges:
        rules += order_low(as_of)
    return rules


def order_catalog(as_of=None) -> RuleSet:
    """Sixteen order rules whose criticality says whether a break rejects the row."""

    def rule(name, check, critical=True):
        return Rule(name, check, ERROR if critical else WARN, "critical" if critical else "medium")

    return RuleSet(
        (
            rule("total_amount_calculation_check", c.equals("total_amount", "quantity * unit_price")),
            *(
                rule(f"positive_{name}_check", c.greater_than(name, 0))
                for name in ("quantity", "unit_price", "total_amount")
            ),
            *(
                rule(f"{name}_not_null_check", c.not_null(name))
                for name in ("order_id", "product_id", "customer_id", "vendor_id")
            ),
            rule("order_id_format_check", c.matches("order_id", ORDER_ID), False),
            rule("currency_code_check", c.one_of("currency", CURRENCIES), False),
            rule("order_status_check", c.one_of("order_status", CATALOG_ORDER_STATUSES)),
            rule("payment_status_check", c.one_of("payment_status", CATALOG_PAYMENT_STATUSES)),
            rule("quantity_reasonable_range_check", c.between("quantity", 1, 10000), False),
            rule(
                "unit_price_reasonable_range_check",
                c.between("unit_price", 0.01, 100000),
                False,
            ),
            rule("timestamp_not_future_check", c.not_after("timestamp", as_of), False),
            rule(
                "created_before_or_equal_timestamp_check",
                c.not_after_column("created_at", "timestamp"),
                False,
            ),
        )
    )


def order_basic() -> RuleSet:
    """The short list of conditions for runs without the full rule set."""
    return RuleSet(
        (
            Rule("total_amount_valid", c.equals("total_amount", "quantity * unit_price")),
            Rule("quantity_positive", c.greater_than("quantity", 0)),
            Rule("unit_price_positive", c.greater_than("unit_price", 0)),
            *(
                Rule(f"{name}_not_null", c.not_null(name) & (c.sql(f"{name} != ''")))
                for name in ("order_id", "product_id", "customer_id")
            ),
            Rule("order_status_valid", c.one_of("order_status", ORDER_STATUSES)),
            Rule("payment_status_valid", c.one_of("payment_status", PAYMENT_STATUSES)),
        )
    )


def order_minimal() -> RuleSet:
    """Seven conditions of presence and sign, for the dataset score."""
    return RuleSet(
        (
            *(
                Rule(f"{name}_positive", c.greater_than(name, 0))
                for name in ("quantity", "unit_price", "total_amount")
            ),
            *(
                Rule(f"{name}_not_null", c.not_null(name))
                for name in ("order_id", "product_id", "customer_id", "vendor_id")
            ),
        )
    )


_PARSED = ("SUCCESS", "PARTIAL")


def order_basic_flag() -> RuleSet:
    """Seven conditions that together decide PASS or FAIL of a parsed order."""
    return RuleSet(
        (
            *(
                Rule(f"{name}_present", c.not_null(name), message=f"{name} missing")
                for name in ("order_id", "product_id", "customer_id")
            ),
            Rule("quantity_positive", c.greater_than("quantity", 0), message="invalid quantity"),
            Rule("unit_price_positive", c.greater_than("unit_price", 0), message="invalid unit_price"),
            Rule(
                "total_amount_valid",
                c.equals("total_amount", "quantity * unit_price"),
                message="total_amount calculation mismatch",
            ),
            Rule("parsed", c.one_of("parsing_status", _PARSED), message="JSON parsing failed"),
        )
    )


def weather_basic() -> RuleSet:
    """Four conditions that together decide PASS or FAIL of a parsed reading."""
    return RuleSet(
        (
            *(
                Rule(f"{name}_present", c.not_null(name), message=f"{name} missing")
                for name in ("event_id", "city", "weather_timestamp")
            ),
            Rule("parsed", c.one_of("parsing_status", _PARSED), message="JSON parsing failed"),
        )
    )


def order_model() -> RuleSet:
    """The five checks of the order model; NULL statuses cannot clash."""
    return RuleSet(
        (
            Rule("quantity_positive", c.greater_than("quantity", 0), message="Quantity must be positive"),
            Rule(
                "unit_price_not_negative",
                c.at_least("unit_price", 0),
                message="Unit price cannot be negative",
            ),
            net_total_matches(),
            *(
                Rule(
                    f"{order.lower()}_not_{payment.lower()}",
                    c.forbidden_pairs("order_status", "payment_status", ((order, payment),)),
                    message=f"{order} order with {payment} payment",
                )
                for order, payment in STATUS_CLASHES
            ),
        )
    )


def framework_rules() -> RuleSet:
    """Completeness, validity, consistency and format; uniqueness is a dataset check."""
    return RuleSet(
        (
            Rule("completeness", c.not_null("order_id") & c.not_null("item_id")),
            Rule("validity", c.greater_than("quantity", 0)),
            Rule("consistency", c.at_least("amount", 0)),
            Rule("timestamp_format", c.matches("timestamp", c.TIMESTAMP_TEXT)),
        )
    )


def framework_rules_unique() -> RuleSet:
    """The rules above with uniqueness beside them; it needs the whole table."""
    return framework_rules() + [unique("order_id", "item_id", name="uniqueness")]


def throughput_rules() -> RuleSet:
    """Five cheap rules over order columns."""
    return RuleSet(
        (
            Rule("completeness", c.not_null("order_id") & c.not_null("item_id")),
            Rule("validity", c.greater_than("quantity", 0)),
            Rule("range", c.between("amount", 0, 10000)),
            Rule("format", c.matches("timestamp", c.TIMESTAMP_TEXT)),
            Rule("enum", c.one_of("status", OPEN_STATUSES)),
        )
    )


def contact_rules() -> RuleSet:
    """Five rules over contact and payment columns."""
    return RuleSet(
        (
            Rule("email", c.matches("email", c.EMAIL)),
            Rule("phone", c.matches("phone", c.PHONE)),
            Rule("payment", c.one_of("payment_method", PAYMENT_METHODS)),
            Rule("amount_range", c.between("amount", 10, 1000)),
            Rule("quantity_positive", c.greater_than("quantity", 0)),
        )
    )


# Constraints of a line item, in JSON-schema form.
LINE_ITEM_SCHEMA = {
    "properties": {
        "order_id": {"type": "string", "pattern": "^ORD[0-9]{8}$"},
        "line_item_id": {"type": "string", "pattern": "^LINE[0-9]{6}$"},
        "item_id": {"type": "string", "pattern": "^ITEM[0-9]{5}$"},
        "quantity": {"type": "integer", "minimum": 1},
        "unit_price": {"type": "number", "minimum": 0},
        "total_amount": {"type": "number", "minimum": 0},
        "store_id": {"type": "string", "pattern": "^STORE[0-9]{3}$"},
        "status": {
            "type": "string",
            "enum": ["NEW", "PROCESSING", "SHIPPED", "DELIVERED", "CANCELLED"],
        },
    },
    "required": ["order_id", "item_id", "quantity", "unit_price"],
}

# Required top-level fields of an event message.
EVENT_MESSAGE_SCHEMA = {
    "properties": {},
    "required": ["message_id", "event_type", "timestamp", "data"],
}

_JSON_TYPES = {"integer": "int", "number": "double"}


def schema_rules(schema: Mapping) -> RuleSet:
    """Rules generated from a JSON-schema style dictionary.

    Required fields must be present; the other constraints concern only values that are there.
    """
    rules = [Rule(f"{name}_required", c.not_null(name)) for name in schema["required"]]
    for name, limits in schema["properties"].items():

        def add(kind, check, name=name):
            rules.append(Rule(f"{name}_{kind}", check, on_null="pass"))

        if limits.get("type") in _JSON_TYPES:
            target = _JSON_TYPES[limits["type"]]
            add("type", c.sql(f"{name} IS NULL OR try_cast({name} AS {target}) IS NOT NULL"))
        if "minimum" in limits:
            add("minimum", c.sql(f"try_cast({name} AS DOUBLE) >= {limits['minimum']}"))
        if "enum" in limits:
            add("enum", c.one_of(name, limits["enum"]))
        if "pattern" in limits:
            add("pattern", c.matches(name, limits["pattern"]))
    return RuleSet(tuple(rules))

