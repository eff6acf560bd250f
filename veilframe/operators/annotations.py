"""Annotated template pages from nested JSON or XML to rows of boxes, and what is picked from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veilframe.operators.boxes import from_percent
from veilframe.operators.text import page_of_path


def as_list(c: Column) -> Column:
    """A field that holds a text, a JSON list of texts, or nothing: always a list."""
    return F.when(c.isNull(), F.array().cast("array<string>")).when(F.ltrim(c).startswith("["), F.from_json(c, "array<string>")).otherwise(F.array(c))


def pages(df: DataFrame) -> DataFrame:
    """One row for each page of annotation documents, numbered by their place; page_no from the image's path.

    df: template, and one row for each page entry with doc_pos (place in the document), image, image_type, roi_type,
    censor_type, close_type, label (array of regions).
    """
    return df.withColumn("page_no", page_of_path(F.col("image")))


def page_numbers(df: DataFrame) -> DataFrame:
    """All page numbers of a template, sorted, repeated ones too."""
    return pages(df).groupBy("template").agg(F.array_sort(F.collect_list("page_no")).alias("page_nos"))


def first_entries(df: DataFrame) -> DataFrame:
    """The first entry of each page number of a template; entries without a number are left out."""
    x = pages(df).filter("page_no IS NOT NULL")
    return x.groupBy("template", "page_no").agg(F.min_by(F.struct(*[c for c in x.columns if c not in ("template", "page_no")]), "doc_pos").alias("e")).select("template", "page_no", "e.*")


def page_size(df: DataFrame) -> DataFrame:
    """width and height as the first region of each page says; null without one."""
    first = F.get("label", F.lit(0))
    return first_entries(df).select("template", "page_no", first["original_width"].alias("width"), first["original_height"].alias("height"))


def page_type(df: DataFrame) -> DataFrame:
    """The redaction type of each page; empty where it isn't given. N needs none."""
    return first_entries(df).select("template", "page_no", F.coalesce("image_type", F.lit("")).alias("image_type"))


def boxes(df: DataFrame) -> DataFrame:
    """template, page_no, pos, label, sub_attribute, x, y, width, height (percent), page_w, page_h, xtl, ytl, xbr, ybr (pixels).

    The k-th roi region of a page has the k-th entry of its roi list as sub_attribute, and so for censor and censor-close;
    beyond the list's end, and for other labels, it is null.
    """
    first = F.get("label", F.lit(0))
    e = first_entries(df).select("template", "page_no", as_list(F.col("roi_type")).alias("roi"), as_list(F.col("censor_type")).alias("cen"), as_list(F.col("close_type")).alias("clo"), first["original_width"].alias("page_w"), first["original_height"].alias("page_h"), F.posexplode("label").alias("pos", "r"))
    e = e.withColumn("label", F.get(F.col("r.rectanglelabels"), F.lit(0)))
    k = F.row_number().over(Window.partitionBy("template", "page_no", "label").orderBy("pos")) - 1
    e = e.withColumn("k", k)
    sub = F.when(F.col("label") == "roi", F.get("roi", F.col("k"))).when(F.col("label") == "censor", F.get("cen", F.col("k"))).when(F.col("label") == "censor-close", F.get("clo", F.col("k")))
    px = from_percent(F.col("r.x"), F.col("r.y"), F.col("r.width"), F.col("r.height"), F.col("page_w"), F.col("page_h"))
    return e.select("template", "page_no", "pos", "label", sub.alias("sub_attribute"), "r.x", "r.y", "r.width", "r.height", "page_w", "page_h", *px.columns())


def align_boxes(b: DataFrame) -> DataFrame:
    return b.filter("sub_attribute = 'align'")


def ocr_boxes(b: DataFrame) -> DataFrame:
    return b.filter("sub_attribute = 'ocr'")


def roi_boxes(b: DataFrame) -> DataFrame:
    """Standard and text regions in order, then the last blank one of the page; a page without a blank one fails loudly."""
    roi = b.filter("label = 'roi'")
    rest = roi.filter("sub_attribute IN ('standard', 'text')").withColumn("is_blank", F.lit(False))
    cols = [c for c in b.columns if c not in ("template", "page_no")]
    last = b.groupBy("template", "page_no").agg(F.max_by(F.when((F.col("label") == "roi") & (F.col("sub_attribute") == "blank"), F.struct(*cols)), F.when((F.col("label") == "roi") & (F.col("sub_attribute") == "blank"), F.col("pos"))).alias("e"))
    checked = last.withColumn("e", F.when(F.col("e").isNull(), F.raise_error(F.concat(F.lit("no blank region on page "), F.col("page_no"))).cast(last.schema["e"].dataType)).otherwise(F.col("e")))
    blank = checked.select("template", "page_no", "e.*").withColumn("is_blank", F.lit(True))
    both = rest.unionByName(blank)
    return both.withColumn("place", F.row_number().over(Window.partitionBy("template", "page_no").orderBy("is_blank", "pos")))


def censor_boxes(b: DataFrame) -> DataFrame:
    return b.filter("label = 'censor'").withColumn("is_partial", F.coalesce(F.col("sub_attribute") == "partial", F.lit(False)))


def close_boxes(b: DataFrame) -> DataFrame:
    return b.filter("label = 'censor-close'")


def with_features(b: DataFrame, features: DataFrame) -> DataFrame:
    """Boxes with what was computed of them beforehand: features by template, page_no, pos."""
    return b.join(features, ["template", "page_no", "pos"], "left")


#: Schema of the XML source's rows, an image each; attributes stay texts.
XML_SCHEMA = "_id STRING, _name STRING, _width INT, _height INT, box ARRAY<STRUCT<_label: STRING, _xtl: DOUBLE, _ytl: DOUBLE, _xbr: DOUBLE, _ybr: DOUBLE, _z_order: INT, _source: STRING, _occluded: STRING, attribute: ARRAY<STRUCT<_name: STRING, _VALUE: STRING>>>>"


def xml_boxes(images: DataFrame) -> DataFrame:
    """id, name, pos, label, box and attributes (a map) of images read by XML_SCHEMA; with width, height, area and centre."""
    e = images.select(F.col("_id").alias("id"), F.col("_name").alias("name"), F.posexplode("box").alias("pos", "b"))
    attrs = F.map_from_entries(F.transform(F.coalesce("b.attribute", F.array().cast("array<struct<_name:string,_VALUE:string>>")), lambda a: F.struct(a["_name"], a["_VALUE"])))
    w, h = F.col("xbr") - F.col("xtl"), F.col("ybr") - F.col("ytl")
    x = e.select("id", "name", "pos", F.col("b._label").alias("label"), *[F.col(f"b._{c}").alias(c) for c in ("xtl", "ytl", "xbr", "ybr")], F.col("b._z_order").alias("z_order"), F.col("b._source").alias("source"), F.col("b._occluded").alias("occluded"), attrs.alias("attributes"))
    return x.withColumns({"width": w, "height": h, "area": F.greatest(w, F.lit(0.0)) * F.greatest(h, F.lit(0.0)), "cx": (F.col("xtl") + F.col("xbr")) / 2, "cy": (F.col("ytl") + F.col("ybr")) / 2})


def find_images(images: DataFrame, id_: str | None = None, name: str | None = None) -> DataFrame:
    """Images with the id and the name given."""
    x = images if id_ is None else images.filter(F.col("_id") == id_)
    return x if name is None else x.filter(F.col("_name") == name)


def attribute(b: Column, name: str) -> Column:
    return b[name]


def set_attribute(b: DataFrame, name: str, value: str, labels: list[str] | None = None, overwrite: bool = True) -> DataFrame:
    """Boxes with an attribute set, where the label is one of those given; changed says where it was."""
    hit = F.lit(True) if labels is None else F.col("label").isin(labels)
    if not overwrite:
        hit = hit & F.col("attributes")[name].isNull()
    rest = F.map_filter("attributes", lambda k, _: k != name)
    return b.withColumn("changed", F.coalesce(hit, F.lit(False))).withColumn("attributes", F.when(F.col("changed"), F.map_concat(rest, F.create_map(F.lit(name), F.lit(value)))).otherwise(F.col("attributes")))


def label_summary(b: DataFrame, image: str = "name") -> DataFrame:
    """Per image: boxes of each label as a map, and the blank attribute of its roi boxes in order."""
    counts = b.groupBy(image, "label").agg(F.count("*").alias("n")).groupBy(image).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("label", "n")))).alias("counts"))
    blanks = F.transform(F.array_sort(F.collect_list(F.when((F.col("label") == "roi") & F.col("attributes")["blank"].isNotNull(), F.struct("pos", F.col("attributes")["blank"].alias("v"))))), lambda x: x["v"])
    return counts.join(b.groupBy(image).agg(blanks.alias("blanks")), image)
