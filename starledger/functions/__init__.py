"""Column-expression helpers (JVM-side built-ins only, no Python UDFs)."""

from starledger.functions.money import (  # noqa: F401
    div_half_away, line_amount, to_money,
)
from starledger.functions.text import (  # noqa: F401
    blank_to_null, na_tokens_to_null, normalize_channel, PANDAS_NA_TOKENS,
)
from starledger.functions.dates import (  # noqa: F401
    DAY_FORMAT, parse_day, parse_day_strict,
)
