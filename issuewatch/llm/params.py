"""Production parameters that queries and their SQL share."""

from __future__ import annotations

#: The mix's weights by level and name, and the budget in percent of all tokens.
MIX_WEIGHTS = {"domain": {"web": 50, "reference": 30, "forum": 20}, "lang": {"en": 55, "fr": 20, "de": 15, "es": 10}, "source": {}}
MIX_BUDGET_PERCENT = 60
MIX_MAX_EPOCHS = 4
MIX_SEED = 1
