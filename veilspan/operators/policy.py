"""Policies and allowlists: small driver-side objects that become literals of a plan."""

from __future__ import annotations

import json
import re
from collections import Counter
from dataclasses import dataclass, field
from pathlib import Path

from pyspark.sql import Column
from pyspark.sql import functions as F

ACTIONS = ("REDACT", "PSEUDONYMIZE", "RETAIN")


@dataclass(frozen=True)
class Rule:
    category: str
    sensitivity: str
    action: str
    patterns: tuple[str, ...]
    exceptions: tuple[str, ...] = ()


@dataclass
class Policy:
    """Pattern names with their categories, and rules of which the first that names a pattern holds."""

    categories: dict[str, str] = field(default_factory=dict)
    rules: list[Rule] = field(default_factory=list)

    @classmethod
    def default(cls) -> Policy:
        # The built-in policy.
        categories = {
            "email": "PII", "phone": "PII", "person_name": "PII", "credit_card": "PII", "ssn": "PII", "address": "PII",
            "hostname": "OPERATIONAL_IDENTIFIERS", "ip_address": "OPERATIONAL_IDENTIFIERS", "api_key": "SECRETS", "database_url": "SECRETS",
            "company_name": "CUSTOMER_ORG_INFO", "customer_id": "CUSTOMER_ORG_INFO", "internal_path": "MISCELLANEOUS",
        }
        rules = [
            Rule("SECRETS", "CRITICAL", "REDACT", ("api_key", "database_url")),
            Rule("PII", "CRITICAL", "REDACT", ("ssn", "credit_card")),
            Rule("PII", "HIGH", "REDACT", ("email",), ("support@company.com", "admin@company.com")),
            Rule("PII", "HIGH", "PSEUDONYMIZE", ("phone",)),
            Rule("PII", "MEDIUM", "PSEUDONYMIZE", ("person_name",)),
            Rule("OPERATIONAL_IDENTIFIERS", "MEDIUM", "PSEUDONYMIZE", ("hostname", "ip_address")),
            Rule("CUSTOMER_ORG_INFO", "LOW", "PSEUDONYMIZE", ("company_name", "customer_id")),
            Rule("PII", "LOW", "RETAIN", ("address",)),
            Rule("MISCELLANEOUS", "MINIMUM", "RETAIN", ("internal_path",)),
        ]
        return cls(categories, rules)

    def load(self, path: str) -> Policy:
        """This policy with a file's patterns added or replaced and, if it has any, its rules instead. A bad file changes nothing."""
        try:
            data = json.loads(Path(path).read_text(encoding="utf-8"))
            categories = self.categories | {p["name"]: p["category"] for p in data.get("patterns", [])}
            rules = [Rule(r["category"], r["sensitivity_level"], r["action"], tuple(r["patterns"]), tuple(r.get("exceptions") or ())) for r in data.get("policies", [])]
        except (OSError, ValueError, KeyError, TypeError):
            return self
        return Policy(categories, rules or self.rules)

    def save(self, path: str) -> None:
        data = {
            "patterns": [{"name": n, "category": c} for n, c in self.categories.items()],
            "policies": [{"category": r.category, "sensitivity_level": r.sensitivity, "action": r.action, "patterns": list(r.patterns), "exceptions": list(r.exceptions) or None} for r in self.rules],
        }
        Path(path).write_text(json.dumps(data, indent=2), encoding="utf-8")

    def action(self, pattern: str, text: str | None = None) -> str:
        if pattern in self.categories:
            for rule in self.rules:
                if pattern in rule.patterns and not (text and any(e in text for e in rule.exceptions)):
                    return rule.action
        return "RETAIN"

    def category(self, pattern: str) -> str | None:
        return self.categories.get(pattern)

    def patterns_with(self, category: str | None = None, action: str | None = None) -> list[str]:
        return [p for p, c in self.categories.items() if category in (None, c) and action in (None, self.action(p))]

    def problems(self) -> list[str]:
        named = Counter(p for r in self.rules for p in r.patterns)
        out = [f"pattern {p} is in {n} rules" for p, n in named.items() if n > 1]
        out += [f"rule names unknown pattern {p}" for p in named if p not in self.categories]
        return out + [f"pattern {p} is in no rule" for p in self.categories if p not in named]

    def summary(self) -> dict:
        return {
            "total_patterns": len(self.categories),
            "total_policies": len(self.rules),
            "categories": dict(Counter(self.categories.values())),
            "actions": dict(Counter(r.action for r in self.rules)),
        }


class Allowlist:
    """Texts that are kept whatever they look like: literals without regard to case, then patterns searched for."""

    def __init__(self, literals=(), patterns=()):
        self.literals = tuple(dict.fromkeys(x.strip().lower() for x in literals))
        self.patterns = tuple(p for p in patterns if _compiles(p))

    @classmethod
    def default(cls) -> Allowlist:
        # Region codes and two families of hosts.
        regions = ("us-east-1", "us-east-2", "us-west-1", "us-west-2", "eu-west-1", "eu-central-1", "ap-southeast-1", "ap-northeast-1")
        return cls(regions, (r"^kafka-broker-\d+(\.[a-z0-9-]+)*$", r"^redis-cache-\d+(\.[a-z0-9-]+)*$"))

    @classmethod
    def load(cls, path: str) -> Allowlist:
        """From a JSON file; a missing or malformed one gives an empty list."""
        try:
            data = json.loads(Path(path).read_text(encoding="utf-8"))
            return cls(data.get("literals", []), data.get("regex_patterns", []))
        except (OSError, ValueError, AttributeError):
            return cls()

    def match(self, text: Column) -> Column:
        """The literal or pattern that a text matches, or null."""
        trimmed = F.regexp_replace(text, r"(?U)^\s+|\s+$", "")
        out = F.lit(None).cast("string")
        for p in reversed(self.patterns):
            out = F.when(trimmed.rlike(p), F.lit(p)).otherwise(out)
        if self.literals:
            out = F.when(F.lower(trimmed).isin(*self.literals), F.lower(trimmed)).otherwise(out)
        return F.when(text != "", out)


def _compiles(pattern: str) -> bool:
    try:
        re.compile(pattern)
    except re.error:
        return False
    return True
