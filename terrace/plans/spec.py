"""Pipeline specs: plain dicts, checked and completed before any Spark call."""

from __future__ import annotations

from copy import deepcopy
from pathlib import Path

WRITE_MODES = {"bronze": "overwrite", "silver": "merge", "gold": "overwrite"}


def _as_dict(spec: dict | str | Path) -> dict:
    if isinstance(spec, dict):
        return deepcopy(spec)
    try:
        import yaml
    except ImportError as e:
        raise ValueError("reading a spec file needs the yaml package; pass a dict") from e
    return yaml.safe_load(Path(spec).read_text())


def _check(spec: dict) -> None:
    if "pipeline_name" not in spec:
        raise ValueError("a spec must say its pipeline_name")
    source = spec.get("source")
    if source is not None:
        if "path" not in source:
            raise ValueError("a source needs the place of its files in source.path")
        if source.get("format", "csv") != "csv":
            raise ValueError("source.format can only be csv")
        if source.get("malformed") not in (None, "report", "drop_row"):
            raise ValueError("source.malformed can be report or drop_row")
    for name, view in (spec.get("views") or {}).items():
        if not callable(view) and len({"sql", "left_join", "once_per_match"} & set(view)) != 1:
            raise ValueError(f"view {name} must be one of sql, left_join and once_per_match")
    for layer, target in (spec.get("targets") or {}).items():
        mode = target.get("write_mode", WRITE_MODES.get(layer))
        if mode != WRITE_MODES.get(layer):
            raise ValueError(f"{layer} is written by {WRITE_MODES.get(layer)}, not {mode}")
    for rule in spec.get("data_quality") or []:
        if rule.get("check", "not_null") != "not_null":
            raise ValueError("the only check is not_null")


def load_spec(spec: dict | str | Path, settings: dict | str | Path | None = None) -> dict:
    """Merge a pipeline spec over the shared settings, check it, fill placeholders.

    Both may be dicts or paths of YAML files; on equal keys the pipeline wins.
    ``{source_base}`` is filled in the source path, ``{catalog}`` in lookup
    tables, in views and in the SQL of a gold table.
    """
    merged = {**_as_dict(settings or {}), **_as_dict(spec)}
    _check(merged)
    lookups = [s for s in merged.get("transformations") or [] if "join_table" in s]
    values = {name: merged[name] for name in ("source_base", "catalog")}
    _fill(values, "source_base", merged.get("source"), "path")
    _fill(values, "catalog", merged, "gold_sql")
    for step in lookups:
        _fill(values, "catalog", step, "join_table")
    for view in (merged.get("views") or {}).values():
        if not callable(view):
            _fill(values, "catalog", view, "sql")
            for how in (view.get("left_join"), view.get("once_per_match")):
                for side in ("left", "right", "keys_of"):
                    _fill(values, "catalog", how, side)
    return merged


def _fill(values: dict[str, str], name: str, part: dict | None, key: str) -> None:
    """Put a value in the place of ``{name}`` in one text of a spec, if it has that text."""
    if part and key in part:
        part[key] = part[key].replace(f"{{{name}}}", values[name])


def table_spec(
    pipeline_name: str,
    table: str,
    key: str,
    identify_by: str,
    columns: list[str],
    transformations: list[dict] = (),
    uppercase: list[str] = (),
    dq_rules: list[dict] | None = None,
    prefix: str = "",
) -> dict:
    """Spec of a CSV table that goes to bronze and silver under the same name.

    The file is ``<table>.csv`` in the source folder, the key is the merge key
    and, unless rules are given, must not be null. ``prefix`` goes before the
    database names, to keep several environments in one catalog.
    """
    rules = [{"column": key, "action": "drop_row"}] if dq_rules is None else dq_rules
    return {
        "pipeline_name": pipeline_name,
        "primary_key": key,
        "identify_by": identify_by,
        "source": {"path": f"{{source_base}}/{table}.csv", "columns": columns},
        "targets": {
            "bronze": {"database": f"{prefix}bronze", "table": table},
            "silver": {"database": f"{prefix}silver", "table": table, "merge_key": key},
        },
        "transformations": [
            *({"column": c, "action": "uppercase"} for c in uppercase),
            *transformations,
        ],
        "data_quality": rules,
    }
