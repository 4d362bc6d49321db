"""Image references: kinds, paths, sizes. Pixels are never read."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tunetables.functions.text import strip

# Extensions taken as image paths, and those that need conversion.
PATH_EXTENSIONS = ("bmp", "gif", "jpeg", "jpg", "png", "tif", "tiff", "webp")
UNSUPPORTED = ("tif", "tiff")


@dataclass(frozen=True)
class ImageOptions:
    root: str = "."
    unsupported: tuple[str, ...] = UNSUPPORTED
    convert: bool = True

    def __post_init__(self) -> None:
        if not self.root.strip():
            raise ValueError("image root must not be empty")


def extension(path: Column) -> Column:
    """Lower-case extension of the last path step; a leading dot is no extension."""
    return F.lower(F.regexp_extract(path, r"(?:\A|/)[^/]*[^./][^/]*\.([^./]*)\z", 1))


def image_kind(value: Column) -> Column:
    """data, url, path or base64 (the candidate left when it is none of them)."""
    v = strip(value)
    looks = v.contains("/") | v.contains("\\") | extension(v).isin(*PATH_EXTENSIONS)
    return (
        F.when(value.isNull(), F.lit(None).cast("string"))
        .when(value.startswith("data:"), "data")
        .when(v.startswith("http://") | v.startswith("https://"), "url")
        .when((v != "") & ~v.startswith("data:") & ~v.contains("base64,") & looks, "path")
        .otherwise("base64")
    )


def normal_path(path: Column) -> Column:
    """``a//b/./c`` and ``a/x/../c`` reduced by text rules, as a fold over steps."""
    steps = F.filter(F.split(path, "/"), lambda s: (s != "") & (s != "."))
    rooted = path.startswith("/")

    def step(acc: Column, s: Column) -> Column:
        top = F.try_element_at(acc, F.lit(-1))
        climbs = (s == "..") & top.isNotNull() & (top != "..")
        stuck = (s == "..") & rooted & top.isNull()
        return F.when(climbs, F.slice(acc, F.lit(1), F.size(acc) - 1)).when(stuck, acc).otherwise(F.array_append(acc, s))

    joined = F.array_join(F.aggregate(steps, F.array().cast("array<string>"), step), "/")
    out = F.when(rooted, F.concat(F.lit("/"), joined)).otherwise(joined)
    return F.when(out == "", F.lit(".")).otherwise(out)


def classify_image(value: Column, opt: ImageOptions = ImageOptions()) -> Column:
    """Reference as it would be loaded: data URIs, URLs and base64 as they are,
    paths made absolute under the root."""
    v = strip(value)
    full = F.when(v.startswith("/"), v).otherwise(F.concat(F.lit(opt.root.rstrip("/") + "/"), v))
    return F.when(image_kind(value) == "path", normal_path(full)).otherwise(value)


def unsupported_extension(path: Column, opt: ImageOptions = ImageOptions()) -> Column:
    return extension(path).isin(*[e.lower().lstrip(".") for e in opt.unsupported])


def checked_image(value: Column, opt: ImageOptions = ImageOptions()) -> Column:
    """F3 with the extension rule: an error when conversion is switched off."""
    out = classify_image(value, opt)
    if opt.convert:
        return out
    bad = (image_kind(value) == "path") & unsupported_extension(out, opt)
    failed = F.raise_error(F.concat(F.lit("unsupported image extension: "), out)).cast("string")
    return F.when(bad, failed).otherwise(out)


def is_content_parts(parts: Column) -> Column:
    """Non-empty and every item typed."""
    return F.coalesce((F.size(parts) > 0) & F.forall(parts, lambda p: p["type"].isNotNull()), F.lit(False))


def collect_images(parts: Column) -> Column:
    """``image`` of the parts of type image, in order."""
    return F.transform(F.filter(parts, lambda p: p["type"] == "image"), lambda p: p["image"])


def collect_turn_images(messages: Column) -> Column:
    """The same over turns whose content is a part list."""
    return F.flatten(F.transform(messages, lambda m: collect_images(m["content"])))


def normalise_payload(value: Column, data_type: T.DataType, opt: ImageOptions = ImageOptions()) -> Column:
    """Image references rewritten wherever a nested value holds them: ``image``
    of image parts, and anything under ``image`` / ``images``. Of an image struct
    the ``path`` is, unless it carries its ``bytes``."""
    if isinstance(data_type, T.ArrayType):
        return F.transform(value, lambda x: normalise_payload(x, data_type.elementType, opt))
    if not isinstance(data_type, T.StructType):
        return value
    names = data_type.fieldNames()
    out = []
    is_image = {"path", "bytes"} <= set(names) and "type" not in names
    for f in data_type.fields:
        c = value[f.name]
        if is_image and f.name == "path":
            c = F.when(value["bytes"].isNull() & c.isNotNull(), checked_image(c, opt)).otherwise(c)
        elif f.name == "image" and "type" in names and isinstance(f.dataType, T.StringType):
            c = F.when(value["type"] == "image", checked_image(c, opt)).otherwise(c)
        elif f.name in ("image", "images", "content"):
            c = normalise_payload(c, f.dataType, opt)
        out.append(c.alias(f.name))
    return F.when(value.isNotNull(), F.struct(*out))


def target_size(width: Column, height: Column, max_pixels: int | None) -> Column:
    """struct(width, height) after scaling into the budget, null when it fits."""
    if max_pixels is None:
        return F.lit(None).cast("struct<width:bigint,height:bigint>")
    total = width.cast("double") * height
    scale = F.sqrt(F.lit(float(max_pixels)) / total)

    def side(c: Column) -> Column:
        return F.greatest(F.lit(1), F.floor(c * scale)).cast("bigint")

    return F.when(total > max_pixels, F.struct(side(width).alias("width"), side(height).alias("height")))


def prompt_payload(prompt: Column, images: Column) -> Column:
    """struct(prompt, image, images): text only, one image, or a list."""
    n = F.size(images)
    return F.struct(
        prompt.alias("prompt"),
        F.when(n == 1, F.get(images, F.lit(0))).alias("image"),
        F.when(n > 1, images).alias("images"),
    )
