from admart.functions.dates import in_trailing_days, latest_date, month_start
from admart.functions.geo import region_of, with_country_code
from admart.functions.json_metrics import json_metric_max, json_metric_sum
from admart.functions.rules import first_match, like_any, like_none
from admart.functions.text import json_quote, json_string, regexp_extract_or_null, strip_quotes, trim_ws

__all__ = ["first_match", "in_trailing_days", "json_metric_max", "json_metric_sum",
           "json_quote", "json_string", "latest_date", "like_any", "like_none", "month_start",
           "regexp_extract_or_null", "region_of", "strip_quotes", "trim_ws", "with_country_code"]
