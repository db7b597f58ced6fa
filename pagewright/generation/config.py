"""Which model plays which role."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any

ROLES = ("text", "vision", "query", "judge")


@dataclass(frozen=True)
class ProviderConfig:
    """Models by role: vision, query and judge fall back to text; extra arguments don't."""

    models: dict[str, str]
    extra: dict[str, dict[str, Any]] = field(default_factory=dict)
    provider: str = "offline"
    region: str | None = None
    max_concurrency: int = 20
    attempts: int = 3
    first_wait: float = 60.0
    most_wait: float = 300.0

    def __post_init__(self) -> None:
        if "text" not in self.models:
            raise ValueError("a model for the role 'text' is needed")
        unknown = (set(self.models) | set(self.extra)) - set(ROLES)
        if unknown:
            raise ValueError(f"unknown roles: {sorted(unknown)}")
        if self.max_concurrency < 1 or self.attempts < 1:
            raise ValueError("max_concurrency and attempts must be positive")
        if self.most_wait < self.first_wait:
            raise ValueError("most_wait must not be below first_wait")

    def model(self, role: str) -> str:
        if role not in ROLES:
            raise ValueError(f"unknown role: {role}")
        return self.models.get(role, self.models["text"])

    def arguments(self, role: str, **own: Any) -> dict[str, Any]:
        """Arguments of a call: its own ones are never overridden by extra ones."""
        return {**self.extra.get(role, {}), **own}

    def concurrency(self, wanted: int) -> int:
        return max(1, min(wanted, self.max_concurrency))
