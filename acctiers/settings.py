"""Defaults for contracts, monitoring thresholds and the tiering model.

Everything here is plain data.  ``merge`` lets a caller override any part of it with a nested
dict, or with a YAML file through ``from_yaml`` when PyYAML is present.
"""

from __future__ import annotations

from copy import deepcopy
from typing import Any

# --- fixed values: data contracts (logical type, nullable) -------------------------------
CONTRACTS: dict[str, dict[str, tuple[str, bool]]] = {
    "customers": {
        "customer_id": ("string", False),
        "business_name": ("string", False),
        "industry": ("string", False),
        "region": ("string", False),
        "employee_count": ("integer", True),
        "signup_date": ("date", False),
        "account_manager": ("string", True),
        "updated_at": ("timestamp", False),
    },
    "products": {
        "product_id": ("string", False),
        "product_name": ("string", False),
        "category": ("string", False),
        "unit_cost": ("float", False),
        "list_price": ("float", False),
        "updated_at": ("timestamp", False),
    },
    "orders": {
        "order_id": ("string", False),
        "customer_id": ("string", False),
        "order_date": ("date", False),
        "status": ("string", False),
        "channel": ("string", False),
        "discount_pct": ("float", False),
        "payment_terms_days": ("integer", False),
        "paid_date": ("date", True),
        "updated_at": ("timestamp", False),
    },
    "order_items": {
        "order_item_id": ("string", False),
        "order_id": ("string", False),
        "product_id": ("string", False),
        "quantity": ("integer", False),
        "unit_price": ("float", False),
        "updated_at": ("timestamp", False),
    },
}

# --- fixed values: sources -----------------------------------------------------------------
SOURCES: dict[str, dict[str, str]] = {
    "customers": {"key": "customer_id", "strategy": "full_refresh", "watermark": "updated_at"},
    "products": {"key": "product_id", "strategy": "full_refresh", "watermark": "updated_at"},
    "orders": {"key": "order_id", "strategy": "incremental", "watermark": "updated_at"},
    "order_items": {"key": "order_item_id", "strategy": "incremental", "watermark": "updated_at"},
}

# --- fixed values: monitoring ----------------------------------------------------------------
FRESHNESS = {
    "load": {"warn": 26.0, "error": 50.0},
    "orders": {"column": "updated_at", "warn": 36.0, "error": 72.0},
    "order_items": {"column": "updated_at", "warn": 36.0, "error": 72.0},
    "customers": {"column": "updated_at", "warn": 168.0, "error": 336.0},
}
VOLUME = {
    "window": 14,
    "min_history": 3,
    "z_warn": 2.5,
    "z_error": 4.0,
    "pct_warn": 0.5,
    "pct_error": 0.9,
    "zero_rows": "error",
}
DRIFT_POLICY = {"added": "warn", "removed": "error", "type_change": "error"}
SEVERITY_RANK = {"pass": 0, "info": 0, "warn": 1, "error": 2}
ALERT_MIN_SEVERITY = "warn"

# observed logical type -> contract types that can take it without loss
LOADABLE_AS = {
    "integer": ("integer", "float", "string"),
    "float": ("float", "string"),
    "boolean": ("boolean", "string"),
    "date": ("date", "timestamp", "string"),
    "timestamp": ("timestamp", "string"),
    "string": ("string",),
    "unknown": ("integer", "float", "boolean", "date", "timestamp", "string"),
}

# --- fixed values: warehouse rules -------------------------------------------------------------
RECOGNIZED_STATUSES = ("completed",)
ACTIVE_WINDOW_DAYS = 90
ORDER_STATUSES = ("completed", "cancelled", "returned")
CHANNELS = ("Field Sales", "Inside Sales", "E-commerce", "Distributor")
PAYMENT_TERMS = (0, 15, 30, 45, 60, 90)
REGIONS = ("Northeast", "Southeast", "Midwest", "Southwest", "West")
SIZE_BANDS = ("Unknown", "Small (<50)", "Mid-market (50-249)", "Enterprise (250+)")
MOVEMENTS = ("New", "Upgraded", "Downgraded", "Stable")

# --- fixed values: tiering model -----------------------------------------------------------------
SCORE_FEATURES = (
    "monetary_12m",
    "frequency_12m",
    "recency_days",
    "gross_margin_pct",
    "revenue_growth",
    "category_breadth",
    "active_month_ratio",
    "late_payment_rate",
    "return_rate",
)
EXTRA_FEATURES = ("avg_order_value", "avg_discount", "tenure_days", "employee_count")
MODEL_FEATURES = SCORE_FEATURES + EXTRA_FEATURES

TIERING: dict[str, Any] = {
    "lookback_days": 365,
    "horizon_days": 180,
    "min_orders": 1,
    "features": {
        "monetary_12m": {"weight": 0.25, "direction": 1, "transform": "log1p"},
        "frequency_12m": {"weight": 0.15, "direction": 1, "transform": "log1p"},
        "recency_days": {"weight": 0.12, "direction": -1, "transform": "none"},
        "gross_margin_pct": {"weight": 0.12, "direction": 1, "transform": "none"},
        "revenue_growth": {"weight": 0.12, "direction": 1, "transform": "none"},
        "category_breadth": {"weight": 0.08, "direction": 1, "transform": "none"},
        "active_month_ratio": {"weight": 0.08, "direction": 1, "transform": "none"},
        "late_payment_rate": {"weight": 0.05, "direction": -1, "transform": "none"},
        "return_rate": {"weight": 0.03, "direction": -1, "transform": "none"},
    },
    "weighting": "config",
    "normalization": "percentile",
    "winsor": (0.01, 0.99),
    "tiers": (("Platinum", 0.10), ("Gold", 0.20), ("Silver", 0.30), ("Bronze", 0.40)),
    "segments": {"k_range": (3, 7), "seed": 42, "n_init": 10},
    "validation": {
        "high_value_quantile": 0.80,
        "bootstrap": 1000,
        "folds": 5,
        "alpha": 0.05,
        "perturbation": 0.20,
        "draws": 200,
        "seed": 42,
    },
}


# --- fixed values: names of the published configuration file, beside those used here ---------
PUBLISHED_NAMES = {
    "weighting_method": "weighting",
    "normalization_method": "normalization",
    "winsorize_quantiles": "winsor",
    "segmentation": "segments",
    "random_state": "seed",
    "bootstrap_iterations": "bootstrap",
    "cv_folds": "folds",
    "weight_perturbation": "perturbation",
    "sensitivity_iterations": "draws",
}


def merge(base: dict, override: dict | None, at: str = "") -> dict:
    """Copy of ``base`` with ``override`` laid over it, dict by dict; unknown keys are an error.

    Feature names are data: a feature table may name others than the default one.
    """
    out = deepcopy(base)
    for key, value in (override or {}).items():
        name = key if key in base else PUBLISHED_NAMES.get(key, key)
        if name not in base and at != "features.":
            raise ValueError(f"unknown setting {at}{key}; known: {', '.join(sorted(base))}")
        if isinstance(value, dict) and isinstance(out.get(name), dict):
            out[name] = merge(out[name], value, f"{at}{name}.") if at != "features." else {**out[name], **value}
        elif name == "tiers":
            out[name] = tuple((t["name"], t["share"]) if isinstance(t, dict) else tuple(t) for t in value)
        else:
            out[name] = deepcopy(value)
    return out


def from_yaml(path: str, base: dict | None = None) -> dict:
    import yaml

    with open(path, encoding="utf-8") as handle:
        return merge(TIERING if base is None else base, yaml.safe_load(handle))


def tier_names(cfg: dict | None = None) -> list[str]:
    return [name for name, _ in (cfg or TIERING)["tiers"]]
