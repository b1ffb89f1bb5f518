"""SQL texts for ratios rounded half-up on integers, so no intermediate scale can shift a result."""

from __future__ import annotations

MONEY = "decimal(28,2)"


def _whole(value: str, digits: int) -> str:
    """`value`, which has at most `digits` decimals, as an integer of 10**-digits units."""
    if digits == 0:
        return f"cast({value} AS decimal(38,0))"
    return f"cast(cast({value} AS decimal(28,{digits})) * {10**digits}BD AS decimal(38,0))"


def half_up(num: str, den: str, places: int, digits: int = 0) -> str:
    """round(num / den, places), half away from zero; NULL when den is 0 or NULL.

    `digits` is the number of decimals either operand may have.
    """
    top = f"abs({_whole(f'({num})', digits)})"
    bottom = f"abs({_whole(f'({den})', digits)})"
    units = f"cast({top} * {2 * 10**places}BD + {bottom} AS decimal(38,0)) div cast({bottom} * 2BD AS decimal(38,0))"
    sign = f"if((({num}) < 0) <> (({den}) < 0), -1, 1)"
    step = f"{10**-places:.{places}f}BD"
    return f"if(({den}) <> 0, cast(cast({units} AS decimal(20,0)) * {sign} * {step} AS decimal(18,{places})), NULL)"


def percent(part: str, whole: str, digits: int = 0) -> str:
    """part / whole * 100 at two decimals; NULL when whole is not positive."""
    return f"if(({whole}) > 0, {half_up(f'({part}) * 100', whole, 2, digits)}, NULL)"


def mean(value: str, places: int = 2, digits: int = 2) -> str:
    """Average over the rows where `value` is known."""
    return half_up(f"sum({value})", f"count({value})", places, digits)


def money(value: str) -> str:
    return f"cast(round({value}, 2) AS {MONEY})"
