"""Token estimates, decimal costs, budget policies and request keys."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

#: Input tokens above which input costs double and output half as much again (fixed values).
LONG_CONTEXT = 272_000


def tokens(text: Column) -> Column:
    """A token for every four bytes begun, one at least; null texts are null."""
    return F.greatest(F.lit(1).cast("long"), F.shiftright(F.octet_length(text) + 3, 2).cast("long"))


def cost(input_tokens: Column, output_tokens: Column, input_price: str, output_price: str, long_context: bool = False) -> Column:
    """Dollars as decimal(18,8), prices per million tokens. With ``long_context`` large requests pay more."""
    a, b = input_tokens.cast("decimal(18,0)"), output_tokens.cast("decimal(18,0)")
    p, q = F.lit(input_price).cast("decimal(8,4)"), F.lit(output_price).cast("decimal(8,4)")
    if long_context:
        large = input_tokens > LONG_CONTEXT
        p = F.when(large, (p * 2).cast("decimal(8,4)")).otherwise(p)
        q = F.when(large, (q * F.lit("1.5").cast("decimal(2,1)")).cast("decimal(8,4)")).otherwise(q)
    return ((a * p + b * q) / F.lit(1_000_000).cast("decimal(7,0)")).cast("decimal(18,8)")


def budget_status(spent: Column, budget: Column, policy: str = "ratio") -> Column:
    """``ratio``: blocked from the budget on, critical from nine tenths, warning from seven. ``limit``: blocked above it.

    Without a budget both say not_configured; ``open`` is ``limit`` that says ok then.
    """
    none = F.when(budget.isNull(), "ok" if policy == "open" else "not_configured")
    if policy in ("limit", "open"):
        return none.when(spent > budget, "blocked").otherwise("ok")
    if policy != "ratio":
        raise ValueError("policy must be ratio, limit or open")
    part = F.try_divide(spent, budget)
    return none.when((budget <= 0) | (part >= 1), "blocked").when(part >= 0.9, "critical").when(part >= 0.7, "warning").otherwise("ok")


def request_id(prefix: str, *parts: Column, length: int = 24) -> Column:
    """``prefix-`` and the first hexadecimal digits of the SHA-256 of the parts, joined by colons."""
    return F.concat(F.lit(f"{prefix}-"), F.left(F.sha2(F.concat_ws(":", *parts), 256), F.lit(length)))
