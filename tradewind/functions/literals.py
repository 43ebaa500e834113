"""Python values as Spark SQL literals. Values are quoted here and nowhere else."""

from collections.abc import Iterable, Mapping
from datetime import date


def text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def day(value: date) -> str:
    return f"DATE'{value.isoformat()}'"


def text_array(values: Iterable[str]) -> str:
    return f"array({', '.join(text(v) for v in values)})"


def day_array(values: Iterable[date]) -> str:
    return f"array({', '.join(day(v) for v in values)})"


def text_map(mapping: Mapping[str, str]) -> str:
    return f"map({', '.join(f'{text(k)}, {text(v)}' for k, v in mapping.items())})"
