"""Query plans: importing this package fills the registry."""

from importlib import import_module

from tickloom.plans.registry import REGISTRY

for _m in (
    "technical",
    "cross_section",
    "season",
    "hygiene",
    "quality",
    "lake",
    "catalog",
    "news",
    "relationship",
    "target",
    "model",
    "research",
    "stream",
    "stage",
):
    import_module(f"tickloom.plans.{_m}_queries")

__all__ = ["REGISTRY"]
