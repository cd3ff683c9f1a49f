"""Column expressions built only from Spark built-ins (JVM-side, codegen'd)."""

from chartwise.functions.casts import coerce_numeric, to_chart_date, to_int_lenient, to_long_lenient  # noqa: F401
from chartwise.functions.markets import market_code, market_key, markets_frame  # noqa: F401
from chartwise.functions.text import ascii_safe, label, normalize_name, strip_ws  # noqa: F401
