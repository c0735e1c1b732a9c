"""Language models behind the finder, the judge and the final review: configuration, prompts and clients.

Nothing here runs unless a caller asks for it: a client is made by a factory on
an executor, once per task, and its key is read there from the environment. Only
the names of environment variables are stored.
"""

from __future__ import annotations

import json
import os
import urllib.request
from collections.abc import Callable
from dataclasses import asdict, dataclass, field
from pathlib import Path

from pyspark.sql import Column
from pyspark.sql import functions as F

ROLES = ("finder", "judge", "fallback")


@dataclass(frozen=True)
class Model:
    """One model of a provider. name is the provider's own name for it and comes from configuration."""

    provider: str
    name: str = ""
    api_key_env_var: str = ""
    max_tokens: int = 1000
    temperature: float = 0.1
    timeout: int = 30

    def key(self) -> str | None:
        """The key in the environment, or None if it is missing or blank."""
        value = os.environ.get(self.api_key_env_var, "").strip()
        return value or None


def _defaults() -> dict[str, Model]:
    return {
        "finder": Model("openai", api_key_env_var="OPENAI_API_KEY", max_tokens=2000),
        "judge": Model("anthropic", api_key_env_var="ANTHROPIC_API_KEY", max_tokens=1500, temperature=0.05),
        "fallback": Model("openai", api_key_env_var="OPENAI_API_KEY", max_tokens=256, temperature=0.2),
    }


@dataclass
class ModelConfig:
    models: dict[str, Model] = field(default_factory=_defaults)
    enable_real_api: bool = False
    api_timeout: int = 30
    retry_attempts: int = 3

    @classmethod
    def load(cls, path: str) -> ModelConfig:
        """From a JSON file with finder_model, judge_model and fallback_model; a missing or malformed file gives the defaults."""
        try:
            data = json.loads(Path(path).read_text(encoding="utf-8"))
            models = {}
            for role in ROLES:
                row = dict(data[f"{role}_model"])
                row["name"] = row.pop("model_name", row.pop("name", ""))
                models[role] = Model(**row)
            return cls(models, bool(data.get("enable_real_api", False)), int(data.get("api_timeout", 30)), int(data.get("retry_attempts", 3)))
        except (OSError, ValueError, KeyError, TypeError, AttributeError):
            return cls()

    def save(self, path: str) -> None:
        data: dict = {}
        for role in ROLES:
            row = asdict(self.models[role])
            data[f"{role}_model"] = {"provider": row.pop("provider"), "model_name": row.pop("name"), **row}
        data |= {"enable_real_api": self.enable_real_api, "api_timeout": self.api_timeout, "retry_attempts": self.retry_attempts}
        Path(path).write_text(json.dumps(data, indent=2), encoding="utf-8")

    def keys_present(self) -> dict[str, bool]:
        return {role: self.models[role].key() is not None for role in ROLES}

    def key(self, role: str) -> str | None:
        return self.models[role].key() if role in self.models else None

    def set_key(self, role: str, value: str) -> bool:
        """Put a key into this process's environment; False for an unknown role."""
        if role not in self.models:
            return False
        os.environ[self.models[role].api_key_env_var] = value
        return True


# What of each provider's protocol a request and an answer look like.
ENDPOINTS = {"openai": "https://api.openai.com/v1/chat/completions", "anthropic": "https://api.anthropic.com/v1/messages"}


def _request(model: Model, prompt: str, url: str | None) -> urllib.request.Request:
    body = {"model": model.name, "max_tokens": model.max_tokens, "temperature": model.temperature, "messages": [{"role": "user", "content": prompt}]}
    headers = {"Content-Type": "application/json"}
    if model.provider == "openai":
        headers["Authorization"] = f"Bearer {model.key()}"
    else:
        headers |= {"x-api-key": model.key() or "", "anthropic-version": "2023-06-01"}
    return urllib.request.Request(url or ENDPOINTS[model.provider], json.dumps(body).encode(), headers)


def _said(provider: str, answer: dict) -> str:
    return answer["choices"][0]["message"]["content"] if provider == "openai" else answer["content"][0]["text"]


def client(model: Model, url: str | None = None) -> Callable[[], Callable[[list[str]], list[str]]]:
    """A model factory for operators/plugins.py: one request for each prompt. Without a key or a known provider every call fails."""

    def factory() -> Callable[[list[str]], list[str]]:
        def run(prompts: list[str]) -> list[str]:
            if model.provider not in ENDPOINTS or model.key() is None:
                raise RuntimeError(f"no client for {model.provider}: unknown provider or no key in {model.api_key_env_var}")
            out = []
            for prompt in prompts:
                with urllib.request.urlopen(_request(model, prompt, url), timeout=model.timeout) as answer:
                    out.append(_said(model.provider, json.load(answer)))
            return out

        return run

    return factory


POLICY = """Sensitivity and usual action:
- critical, always REDACT: social security numbers, card numbers, keys and other secrets, database addresses, account numbers
- high, REDACT or PSEUDONYMIZE: e-mail addresses other than public support ones, private telephone numbers, postal addresses, license numbers
- medium, PSEUDONYMIZE: names of employees and contractors, internal hosts, customer numbers, ticket references
- low, RETAIN: company names, general places, public links, technical terms
Laws to keep: GDPR, CCPA, SOX, HIPAA. Security reports and support chats are of high risk, talk about employees of medium, public documents of low.
"""


def _template(template: str, /, **columns: Column) -> Column:
    """A text with columns in the places of their names in double angle brackets."""
    parts, rest = [], template
    while "<<" in rest:
        before, _, tail = rest.partition("<<")
        name, _, rest = tail.partition(">>")
        parts += [F.lit(before), F.coalesce(columns[name].cast("string"), F.lit(""))]
    return F.concat(*parts, F.lit(rest))


def finder_prompt(text: Column, candidates: Column) -> Column:
    """Asks what else around the known candidates is sensitive."""
    known = F.array_join(F.transform(candidates, lambda c: F.concat(F.lit("- "), c["span_id"], F.lit(": '"), c["text"], F.lit("' at "), c["start"].cast("string"), F.lit("-"), c["end"].cast("string"))), "\n")
    ask = "Which sensitive information is in this text beside the known spans? Look at jobs and teams, money, internal operations and technical detail.\n\nText: <<text>>\n\nKnown spans:\n<<known>>\n\nAnswer with JSON only: {\"span_analyses\": [{\"span_id\": \"\", \"additional_pii\": \"\", \"confidence\": 0.0, \"reasoning\": \"\"}]}\n"
    return _template(ask, text=F.substring(text, 1, 1000), known=known)


def judge_prompt(text: Column, finding: Column, policy: str = POLICY) -> Column:
    """Asks for the action on one finding."""
    ask = (
        "Decide whether the finding below must be redacted.\n\nType: <<type>>\nText: \"<<found>>\"\nConfidence: <<sure>>\n\nContext: <<text>>\n\nPolicy:\n<<policy>>\n"
        "Answer with JSON only: {\"decision\": \"REDACT|PSEUDONYMIZE|RETAIN\", \"confidence\": 0.0, \"reasoning\": \"\", \"policy_violation_level\": \"HIGH|MEDIUM|LOW|NONE\", \"risk_factors\": [], \"policy_alignment\": true}\n"
    )
    return _template(ask, type=finding["entity_type"], found=finding["text"], sure=finding["confidence"], text=F.substring(text, 1, 500), policy=F.lit(policy))


def review_prompt(piece: Column) -> Column:
    """Asks whether a rewritten text still holds anything sensitive."""
    ask = (
        "The text below was redacted. Does it still hold personal data, secrets or identifiers? Placeholders and pseudonyms are fine.\n\n<<text>>\n\n"
        "Answer with JSON only: {\"is_clean\": true, \"confidence\": 0.0, \"overall_assessment\": \"\", \"issues\": [{\"snippet\": \"\", \"issue_type\": \"\", \"severity\": \"\", \"reasoning\": \"\"}]}\n"
    )
    return _template(ask, text=piece)
