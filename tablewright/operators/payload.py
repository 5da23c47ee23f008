"""Outbound documents.

One nested document per row, built with column expressions:

    events[ {data: {event_name, custom_event_type, <event attributes>},
             event_type} ],
    source_request_id, environment, user_attributes{...},
    user_identities{...}, context{data_plan{plan_id[, plan_version]}}

The category map says which projected column lands where: identities are
keyed by the lower-cased target name, attributes keep their case. Columns nest
by their type (N2, see ``nesting``); text columns named in
``json_columns`` are parsed first (bad text becomes null, not a failed job). An
event attribute mapped to ``event_type`` moves out of the data to the event
(N4). Nulls stay in the JSON text as null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import VariantType

from tablewright.functions.scalars import request_id
from tablewright.operators.nesting import nested

# Fixed values of the outbound document.
DEFAULT_EVENT_TYPE = "custom_event"
DEFAULT_CUSTOM_EVENT_TYPE = "other"
JSON_OPTIONS = {"ignoreNullFields": "false"}


def _prop(props: dict, name: str):
    for k, v in props.items():
        if k.lower() == name:
            return v
    return None


def context_struct(props: dict) -> Column:
    """``plan_id`` is required, ``plan_version`` only when given."""
    plan_id = _prop(props, "plan_id")
    if not plan_id:
        raise ValueError("plan_id not found in target properties")
    fields = [F.lit(str(plan_id)).alias("plan_id")]
    version = _prop(props, "plan_version")
    if version:
        fields.append(F.lit(str(version)).alias("plan_version"))
    return F.struct(F.struct(*fields).alias("data_plan"))


def build_payload(df: DataFrame, cmap: dict, props: dict, environment: str,
                  run_id: int, key: str, json_columns: tuple = (),
                  carry: tuple = ()) -> DataFrame:
    """Returns ``key, request_id, payload (struct), data (JSON text)`` plus
    the ``carry`` columns unchanged."""
    types = {f.name.lower(): f.dataType for f in df.schema.fields}

    def value(alias: str, category: str) -> Column:
        c = F.col(f"`{alias}`")
        if alias in json_columns:
            return nested(VariantType(), F.try_parse_json(c), category)
        return nested(types[alias.lower()], c, category)

    identities = cmap.get("user_identities", {})
    attributes = cmap.get("user_attributes", {})
    event_attrs = cmap.get("app_event_attributes", {})

    data: dict[str, Column] = {
        "event_name": F.lit(_prop(props, "event_name")).cast("string"),
        "custom_event_type": F.lit(_prop(props, "event_type") or DEFAULT_CUSTOM_EVENT_TYPE),
    }
    event_type = F.lit(DEFAULT_EVENT_TYPE)
    for alias, target in sorted(event_attrs.items()):
        if target == "event_type":
            event_type = F.coalesce(F.col(f"`{alias}`").cast("string"), F.lit(DEFAULT_EVENT_TYPE))
        else:
            data[target] = value(alias, "app_event_attributes")
    event = F.struct(F.struct(*[c.alias(n) for n, c in data.items()]).alias("data"),
                     event_type.alias("event_type"))
    rid = request_id(F.lit(run_id), F.col(key))
    payload = F.struct(
        F.array(event).alias("events"),
        rid.alias("source_request_id"),
        F.lit(environment).alias("environment"),
        F.struct(*[value(a, "user_attributes").alias(t) for a, t in sorted(attributes.items())]).alias("user_attributes"),
        F.struct(*[value(a, "user_identities").alias(t.lower()) for a, t in sorted(identities.items())]).alias("user_identities"),
        context_struct(props).alias("context"),
    )
    return (df.select(F.col(key), *carry, payload.alias("payload"))
              .select(key, F.col("payload.source_request_id").alias("request_id"), "payload",
                      F.to_json("payload", JSON_OPTIONS).alias("data"), *carry))
