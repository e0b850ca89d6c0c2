"""Small text helpers for the oracle SQL."""


def up(x: str, digits: int) -> str:
    """Round half away from zero over the decimal value."""
    return f"CAST(round(CAST({x} AS DECIMAL(38,8)), {digits}) AS DOUBLE)"


def even(x: str, digits: int) -> str:
    return f"CAST(round_even(CAST({x} AS DECIMAL(38,8)), {digits}) AS DOUBLE)"


def div(a: str, b: str) -> str:
    return f"(CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0))"


def pct(a: str, b: str, digits: int) -> str:
    return up(f"{div(a, b)} * 100", digits)


def money(x: str) -> str:
    return f"CAST(round({x}, 2) AS DOUBLE)"


def dbl(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"
