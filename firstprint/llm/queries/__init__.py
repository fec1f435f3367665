"""The operators over the driver tables."""

from importlib import import_module

MODULES = ["packing", "extraction", "toxicity", "language", "licenses", "quality", "token_counts", "chat", "decontaminate", "neardup",
           "alignment", "negatives", "forest"]


def load_all() -> None:
    for name in MODULES:
        import_module(f"firstprint.llm.queries.{name}")
