"""The difference of two bodies as JSON Patch (RFC 6902) operations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docalign.functions import cells as C


def diff_documents(
    documents: DataFrame,
    old: str = "metadata",
    new: str = "modified_metadata",
    into: str = "json_patch",
) -> DataFrame:
    """Operations that turn ``old`` into ``new``, sorted by operation and path.

    ``array<struct<op, path, kind, text>>`` with ``add``, ``remove`` and
    ``replace`` on whole fields; ``kind`` and ``text`` are null for ``remove``.
    """
    context = F.struct(
        F.col(new).alias("new"),
        C.by_name(F.col(old)).alias("old_by_name"),
        F.array_except(C.names(F.col(old)), C.names(F.col(new))).alias("gone"),
    )

    def operations(x: Column) -> Column:
        removed = F.transform(x["gone"], lambda n: _operation(F.lit("remove"), n))

        def change(c: Column) -> Column:
            before = F.try_element_at(x["old_by_name"], c["field"])
            return F.when(
                before.isNull(), _operation(F.lit("add"), c["field"], c["kind"], c["text"])
            ).when(before != c, _operation(F.lit("replace"), c["field"], c["kind"], c["text"]))

        changed = F.array_compact(F.transform(x["new"], change))
        # A path occurs once, so operation and path already decide the order.
        return F.sort_array(F.concat(changed, removed))

    return documents.withColumn(into, C.let(context, operations))


def _operation(op: Column, field: Column, kind: Column | None = None, text: Column | None = None) -> Column:
    escaped = F.when(
        field.rlike("[~/]"), F.replace(F.replace(field, F.lit("~"), F.lit("~0")), F.lit("/"), F.lit("~1"))
    ).otherwise(field)
    none = F.lit(None).cast("string")
    return F.struct(
        op.alias("op"),
        F.concat(F.lit("/"), escaped).alias("path"),
        (none if kind is None else kind).alias("kind"),
        (none if text is None else text).alias("text"),
    )
