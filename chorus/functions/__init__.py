"""Column-level helpers: every function returns a ``Column`` built from
``pyspark.sql.functions`` so it stays inside whole-stage codegen."""

from chorus.functions.dates import (  # noqa: F401
    MONTH_NAMES, concat_ws_null, date_parts, month_name_to_num, month_start,
    month_year, parse_date, parse_timestamp, ts_to_date,
)
from chorus.functions.labels import score_label, topic_tag  # noqa: F401
from chorus.functions.text import (  # noqa: F401
    keyword_pattern, mentions, nan_to_null, tokens,
)
