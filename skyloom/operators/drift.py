"""Schemas that drift between files: every change between successive files, and one consistent table of all rows.

Rows are loaded as path-value maps with raw JSON types; the statistics of paths and types are aggregated by file; changes are read
off these statistics, and typed columns are projected with a report of the casts that fail.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from skyloom.functions.text import is_na_token, number, strip
from skyloom.session import Scratch

#: The typed columns of the consistent table.
TYPES = {"id": "string", "ra": "double", "dec": "double", "z": "double", "z_flag": "double", "z_err": "double", "survey": "string"}


def path_values(rows: DataFrame, file: str, row: str, payload: str) -> DataFrame:
    """(file, row, field, value, type): one row for each field of each JSON object, names case-sensitive.

    ``value`` is the text of the value and ``type`` one of integer, fractional, string, boolean, object, array; both are null for
    missing values and missing-value tokens. Payloads that are null or no JSON object give no rows.
    """
    parsed = rows.select(F.col(file).alias("file"), F.col(row).alias("row"), F.try_parse_json(payload).alias("v"))
    flat = parsed.lateralJoin(rows.sparkSession.tvf.variant_explode(F.col("v").outer()))
    kind = F.expr("schema_of_variant(value)")
    digits = F.regexp_extract(kind, r"^DECIMAL\((\d+),0\)$", 1)
    kind = (
        F.when((kind == "BIGINT") | (F.coalesce(digits.try_cast("int"), F.lit(0)) >= 19), "integer")
        .when(kind.rlike("^(DECIMAL|DOUBLE|FLOAT)"), "fractional")
        .when(kind == "STRING", "string").when(kind == "BOOLEAN", "boolean")
        .when(kind.startswith("OBJECT"), "object").when(kind.startswith("ARRAY"), "array")
    )
    text = F.when(kind.isin("object", "array"), F.to_json("value")).otherwise(F.expr("try_cast(value as string)"))
    out = flat.select("file", "row", F.col("key").alias("field"), text.alias("value"), kind.alias("type"))
    missing = is_na_token(F.col("value"))
    return out.withColumn("type", F.when(~missing, F.col("type"))).withColumn("value", F.when(~missing, F.col("value")))


def canonical(value: Column) -> Column:
    """Equal for values that agree apart from type: numbers by value, other text without outer blanks."""
    t = strip(value)
    whole = F.regexp_extract(t, r"^\+?(-?)0*(\d+)(?:\.0*)?$", 2)
    sign = F.regexp_extract(t, r"^\+?(-?)0*(\d+)(?:\.0*)?$", 1)
    n = number(t)
    return (
        F.when(whole != "", F.when(whole == "0", "0").otherwise(F.concat(sign, whole)))
        .when(n.isNotNull(), F.when((n == F.floor(n)) & (F.abs(n) < 1e15), n.cast("long").cast("string")).otherwise(n.cast("string")))
        .when(F.lower(t).isin("true", "false"), F.lower(t))
        .otherwise(t)
    )


class Drift:
    """The drift of typed files.

    ``rows``: (file_id, row_id, payload); ``files``: (file_id, series, release_no, source); ``columns``: the field names of each
    source at its first release. A file's predecessor is the file before it by release_no (ties by file_id) in its series among the
    files that have rows; files without series have none. Position fields are those of ``columns`` by source.
    """

    def __init__(self, rows: DataFrame, files: DataFrame, columns: DataFrame):
        self.scratch = Scratch(rows.sparkSession, "drift")
        self.rows, self.columns = rows, columns
        self.values = self.scratch.keep(path_values(rows, "file_id", "row_id", "payload"))
        self.fields = self.scratch.keep(
            self.values.groupBy("file", "field").agg(F.array_join(F.array_sort(F.collect_set("type")), "|").alias("types"))
        )
        present = self.fields.select("file").distinct()
        order = W.partitionBy("series").orderBy("release_no", "file_id")
        self.files = (
            files.dropDuplicates(["file_id"]).join(present, F.col("file_id") == F.col("file"), "left_semi")
            .select("file_id", "series", "source", "release_no", F.when(F.col("series").isNotNull(), F.lag("file_id").over(order)).alias("prev"))
        )
        self.pairs = self.files.where("prev is not null").select(F.col("file_id").alias("file"), "prev")

    def _digests(self) -> DataFrame:
        """(pair, file, field, n, digest): how many (object, value) a field has over the objects in both files of a pair, and their digest."""
        where = self.files.join(self.columns.select("source", "ra_column", "dec_column"), "source").select(
            F.col("file_id").alias("file"), "ra_column", "dec_column"
        )
        v = self.values.where("value is not null").withColumn("c", canonical(F.col("value")))
        at = v.join(where, "file").where("field = ra_column or field = dec_column")
        at = at.groupBy("file", "row").agg(
            F.max(F.when(F.col("field") == F.col("ra_column"), F.col("c"))).alias("ra"), F.max(F.when(F.col("field") == F.col("dec_column"), F.col("c"))).alias("dec")
        ).where("ra is not null and dec is not null")
        at = self.scratch.keep(at)
        objects = at.select("file", "ra", "dec").distinct()
        both = (
            self.pairs.join(objects, "file").join(objects.withColumnRenamed("file", "prev"), ["prev", "ra", "dec"])
            .select(F.col("file").alias("pair"), F.explode(F.array("file", "prev")).alias("file"), "ra", "dec")
        )
        claims = v.join(at, ["file", "row"]).select("file", "ra", "dec", "field", "c").distinct()
        claims = claims.join(both, ["file", "ra", "dec"])
        digest = F.sum(F.xxhash64("ra", "dec", "c").cast("decimal(38,0)"))
        return claims.groupBy("pair", "file", "field").agg(F.count(F.lit(1)).alias("n"), digest.alias("digest"))

    def changes(self) -> DataFrame:
        """(file_id, change, old_field, new_field), distinct.

        renamed: of two names of which one goes and one comes, all objects in both files (same position) have values that agree
        apart from type, and at least one value is there; if several names would do, they pair in order of name. added and removed:
        all other names. retyped: a kept or renamed field whose JSON types differ; missing values have no type.
        """
        new = self.pairs.join(self.fields, "file").select(F.col("file").alias("pair"), "field", "types")
        old = self.pairs.join(self.fields.withColumnRenamed("file", "prev"), "prev").select(F.col("file").alias("pair"), F.col("field").alias("f"), F.col("types").alias("t"))
        all_names = self.scratch.keep(
            new.join(old, (new["pair"] == old["pair"]) & (new["field"] == old["f"]), "full")
            .select(F.coalesce(new["pair"], old["pair"]).alias("pair"), F.col("f").alias("old"), F.col("field").alias("new"), F.col("t").alias("old_types"), F.col("types").alias("new_types"))
        )
        gone, come, kept = all_names.where("new is null"), all_names.where("old is null"), all_names.where("old is not null and new is not null")
        digests = self.scratch.keep(self._digests())
        rank = W.partitionBy("pair", "n", "digest").orderBy("name")

        def keyed(names: DataFrame, name: str, newer: bool) -> DataFrame:
            file = digests.where((F.col("pair") == F.col("file")) == F.lit(newer))
            j = names.select("pair", F.col(name).alias("name"), F.col(f"{name}_types").alias("types")).join(
                file.select("pair", F.col("field").alias("name"), "n", "digest"), ["pair", "name"]
            )
            return j.withColumn("k", F.row_number().over(rank)).withColumnsRenamed({"name": name, "types": f"{name}_types"})

        renamed = self.scratch.keep(keyed(gone, "old", False).join(keyed(come, "new", True), ["pair", "n", "digest", "k"]).select("pair", "old", "new", "old_types", "new_types"))
        removed = gone.join(renamed, ["pair", "old"], "left_anti").select("pair", F.lit("removed").alias("change"), "old", F.lit("").alias("new"))
        added = come.join(renamed, ["pair", "new"], "left_anti").select("pair", F.lit("added").alias("change"), F.lit("").alias("old"), "new")
        typed = kept.unionByName(renamed).where("old_types <> new_types and old_types <> '' and new_types <> ''")
        out = (
            renamed.select("pair", F.lit("renamed").alias("change"), "old", "new").unionByName(removed).unionByName(added)
            .unionByName(typed.select("pair", F.lit("retyped").alias("change"), "old", "new"))
        )
        return out.select(F.col("pair").alias("file_id"), "change", F.col("old").alias("old_field"), F.col("new").alias("new_field"))

    def lineage(self, changes: DataFrame) -> DataFrame:
        """(file, field, origin, first): the name under which a field first appeared in its series, followed through renames, and the file.

        Links to the file before are shortened to links to the origin by pointer doubling, so that a series of n files takes log n rounds.
        """
        before = changes.where("change = 'renamed'").select(F.col("file_id").alias("file"), F.col("new_field").alias("field"), "old_field")
        links = (
            self.fields.join(self.pairs, "file", "left").join(before, ["file", "field"], "left")
            .select("file", "field", F.col("prev").alias("to_file"), F.coalesce("old_field", "field").alias("to_field"))
        )
        known = self.fields.select(F.col("file").alias("to_file"), F.col("field").alias("to_field"), F.lit(True).alias("there"))
        links = links.join(known, ["to_file", "to_field"], "left").select(
            "file", "field", F.when(F.col("there"), F.col("to_file")).alias("to_file"), F.when(F.col("there"), F.col("to_field")).alias("to_field")
        )
        links = self.scratch.keep(links.withColumn("to_file", F.coalesce("to_file", "file")).withColumn("to_field", F.coalesce("to_field", "field")))
        while True:
            ahead = links.select(F.col("file").alias("to_file"), F.col("field").alias("to_field"), F.col("to_file").alias("f2"), F.col("to_field").alias("n2"))
            jumped = links.join(ahead, ["to_file", "to_field"]).select("file", "field", F.col("f2").alias("to_file"), F.col("n2").alias("to_field"))
            jumped = self.scratch.keep(jumped)
            moved = jumped.join(links, ["file", "field", "to_file", "to_field"], "left_anti").isEmpty()
            links = jumped
            if moved:
                return links.select("file", "field", F.col("to_field").alias("origin"), F.col("to_file").alias("first"))

    def _placed(self, changes: DataFrame) -> DataFrame:
        """(file, field, origin, column) of every field; ``column`` is null for fields that no typed column takes.

        If several fields of a file have the origin of a column, the one that has been there longest takes it.
        """
        names = [F.struct(F.lit(c).alias("column"), F.col(f"{c}_column").alias("origin")) for c in TYPES]
        mapping = self.columns.select("source", F.explode(F.array(*names)).alias("m")).select("source", "m.column", "m.origin").where("origin is not null").distinct()
        files = self.files.select(F.col("file_id").alias("file"), "source")
        first = self.files.select(F.col("file_id").alias("first"), "release_no")
        to = self.lineage(changes).join(files, "file", "left").join(first, "first", "left").join(mapping, ["source", "origin"], "left")
        rank = F.row_number().over(W.partitionBy("file", "column").orderBy(F.asc_nulls_last("release_no"), "first", "field"))
        return to.select("file", "field", "origin", F.when(rank == 1, F.col("column")).alias("column"))

    def table(self, changes: DataFrame) -> DataFrame:
        """Every row once, in one schema: (row_id, file_id, id, ra, dec, z, z_flag, z_err, survey, other, failed).

        A field goes to the column that its name at its first appearance is mapped to. The values of all other fields are in ``other``,
        an array in order of (origin, field, value, type), which unlike a map keeps two fields of one origin apart and can be compared.
        Values that a column's type can't hold are null and listed in ``failed`` as ``column=value``. Rows whose payload is no JSON
        object have all columns null; the payload, unless missing, is in ``failed`` as ``payload=text``.
        """
        v = self.values.where("value is not null").join(self._placed(changes), ["file", "field"])
        typed, failed = [], []
        for c, t in TYPES.items():
            here = F.when(F.col("column") == c, F.col("value"))
            typed.append(F.max(here if t == "string" else number(here)).alias(c))
            if t != "string":
                failed.append(F.max(F.when((F.col("column") == c) & number(F.col("value")).isNull(), F.concat(F.lit(f"{c}="), F.col("value")))))
        other = F.array_sort(F.collect_set(F.when(F.col("column").isNull(), F.struct("origin", "field", "value", "type")))).alias("other")
        wide = v.groupBy("row").agg(*typed, other, F.array_compact(F.array(*failed)).alias("failed"))
        whole = F.try_parse_json("payload")
        is_object = F.coalesce(F.schema_of_variant(whole).startswith("OBJECT"), F.lit(False))
        no_object = F.when(~is_object & ~is_na_token(F.col("payload")), F.concat(F.lit("payload="), F.col("payload")))
        rows = self.rows.select("row_id", "file_id", no_object.alias("no_object"))
        out = rows.join(wide, F.col("row_id") == F.col("row"), "left").drop("row")
        out = out.withColumn("other", F.coalesce("other", F.array().cast(wide.schema["other"].dataType)))
        return out.withColumn("failed", F.coalesce("no_object", F.array_join("failed", ";"), F.lit(""))).drop("no_object")
