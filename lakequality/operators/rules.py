"""Rules and sets of rules: data, not code paths."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql import Column
from pyspark.sql import functions as F

ERROR = "error"
WARN = "warn"
CRITICALITIES = (ERROR, WARN)
CATEGORIES = ("critical", "high", "medium", "low")


@dataclass(frozen=True)
class Rule:
    """A named condition on a row. `check` is a boolean column or SQL text."""

    name: str
    check: Column | str = field(compare=False)
    criticality: str = ERROR
    category: str = "critical"
    message: str | None = None
    on_null: str = "fail"

    def __post_init__(self):
        if not self.name or not self.name.replace("_", "a").isalnum():
            raise ValueError(f"a rule needs a name of letters, digits and underscores: {self.name!r}")
        if self.check is None or (isinstance(self.check, str) and not self.check.strip()):
            raise ValueError(f"rule {self.name} has no check")
        if self.criticality not in CRITICALITIES:
            raise ValueError(f"rule {self.name}: criticality must be one of {CRITICALITIES}")
        if self.category not in CATEGORIES:
            raise ValueError(f"rule {self.name}: category must be one of {CATEGORIES}")
        if self.on_null not in ("fail", "pass"):
            raise ValueError(f"rule {self.name}: on_null must be 'fail' or 'pass'")

    @property
    def text(self) -> str:
        return self.message or self.name

    def passed(self) -> Column:
        """True or false, never NULL."""
        check = F.expr(self.check) if isinstance(self.check, str) else self.check
        return F.coalesce(check, F.lit(self.on_null == "pass"))


@dataclass(frozen=True)
class GroupRule(Rule):
    """A named condition on all rows of a key together; rows of a group that breaks it break the rule.

    `check` is a boolean aggregate, as `count(1) = 1`, true for good groups. Null keys are a key of
    their own; with `on_null="pass"` rows that lack a key are left alone, and so are groups whose check
    is NULL.
    """

    keys: tuple[str, ...] = ()

    def __post_init__(self):
        super().__post_init__()
        object.__setattr__(self, "keys", (self.keys,) if isinstance(self.keys, str) else tuple(self.keys))
        if not self.keys:
            raise ValueError(f"rule {self.name} needs the keys of its groups")

    def passed(self) -> Column:
        raise TypeError(f"rule {self.name} is on groups; the quality functions that take a table apply it")


def unique(*keys: str, name: str | None = None, **options) -> GroupRule:
    """No other row has the same keys."""
    options.setdefault("message", f"{', '.join(keys)} not unique")
    return GroupRule(name or "_".join(("unique", *keys)), "count(1) = 1", keys=keys, **options)


def rule_from_config(config: Mapping) -> Rule:
    """A rule from a dictionary, on groups when it has `keys`; missing entries raise ValueError."""
    missing = [name for name in ("name", "check") if not config.get(name)]
    if missing:
        raise ValueError(f"rule configuration lacks {', '.join(missing)}")
    kind = GroupRule if "keys" in config else Rule
    unknown = set(config) - set(kind.__dataclass_fields__)
    if unknown:
        raise ValueError(f"rule configuration has unknown entries: {', '.join(sorted(unknown))}")
    return kind(**config)


@dataclass(frozen=True)
class RuleSet:
    """An ordered, immutable collection of rules."""

    rules: tuple[Rule, ...]

    def __post_init__(self):
        names = [rule.name for rule in self.rules]
        repeated = sorted({name for name in names if names.count(name) > 1})
        if repeated:
            raise ValueError(f"rule names must be unique: {', '.join(repeated)}")

    def __iter__(self):
        return iter(self.rules)

    def __len__(self):
        return len(self.rules)

    def __add__(self, other: Iterable[Rule]) -> RuleSet:
        return RuleSet((*self.rules, *other))

    def add(self, rule: Rule, category: str | None = None) -> RuleSet:
        return self + [replace(rule, category=category) if category else rule]

    def category(self, *categories: str) -> RuleSet:
        return RuleSet(tuple(rule for rule in self.rules if rule.category in categories))

    def critical(self) -> RuleSet:
        return self.category("critical")

    def warnings(self) -> RuleSet:
        return self.category("high", "medium", "low")

    def without(self, *names: str) -> RuleSet:
        return RuleSet(tuple(rule for rule in self.rules if rule.name not in names))

    def counts(self) -> dict[str, int]:
        return {category: len(self.category(category)) for category in CATEGORIES}

    def usable(self, threshold: float = 0.95) -> bool:
        """At least one rule, and a threshold that is a share."""
        return len(self) > 0 and 0.0 <= threshold <= 1.0
