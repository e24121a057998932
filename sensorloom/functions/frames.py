"""Frame expressions. A frame is raw bytes (row-major, channels innermost) or an array of pixel values."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# PNG signature, and the colour type codes with their number of components.
PNG_SIGNATURE = "89504E470D0A1A0A"
PNG_COMPONENTS = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}
MARGIN = 1


def grid_size(count: Column) -> Column:
    """Tiles per row and per column of a square grid."""
    return F.ceil(F.sqrt(count)).cast("int")


def cell_x(position: Column, size: Column, width: int, margin: int = MARGIN) -> Column:
    return (position % size * F.lit(width + margin)).cast("int")


def cell_y(position: Column, size: Column, height: int, margin: int = MARGIN) -> Column:
    return (F.floor(position / size) * F.lit(height + margin)).cast("int")


def canvas_side(size: Column, tile: int, margin: int = MARGIN) -> Column:
    return (size * F.lit(tile + margin) - F.lit(margin)).cast("int")


def mean_score(pixels: Column) -> Column:
    """Mean pixel value over 255, of an array of pixel values."""
    total = F.aggregate(pixels, F.lit(0).cast("bigint"), lambda acc, p: acc + p)
    return total / F.size(pixels) / F.lit(255.0)


def to_bytes(pixels: Column) -> Column:
    """Pack an array of values 0..255."""
    return F.unhex(F.array_join(F.transform(pixels, lambda p: F.lpad(F.hex(p), 2, "0")), ""))


def to_pixels(vector: Column) -> Column:
    """Grey values 0..255 of an array of numbers in -1..1."""
    return F.transform(vector, lambda v: F.round((v.cast("double") + 1) * 127.5).cast("int"))


def compose(tiles: Column, size: Column, width: int, height: int, background: int = 0,
            margin: int = MARGIN, channels: int = 1) -> Column:
    """The canvas bytes of a square grid; ``tiles`` is a map from position to raw tile bytes.

    Works on whole pixel rows: a canvas row is the same row of each tile in the grid row, with margins.
    """
    dot = f"{background:02X}" * channels
    blank = F.lit(dot * width)

    def canvas_row(grid_row: Column, y: Column) -> Column:
        def part(grid_column: Column) -> Column:
            tile = F.try_element_at(tiles, (grid_row * size + grid_column).cast("int"))
            start = (y * (width * channels) + 1).cast("int")
            return F.coalesce(F.hex(tile.substr(start, F.lit(width * channels))), blank)
        return F.array_join(F.transform(F.sequence(F.lit(0), size - 1), part), dot * margin)

    side = canvas_side(size, width, margin)
    margin_rows = F.repeat(F.lit(dot), side * margin)

    def grid_row_hex(grid_row: Column) -> Column:
        rows = F.transform(F.sequence(F.lit(0), F.lit(height - 1)), lambda y: canvas_row(grid_row, y))
        return F.array_join(rows, "")

    bands = F.transform(F.sequence(F.lit(0), size - 1), grid_row_hex)
    # The margin between bands is as wide as the canvas, so it cannot be a literal delimiter.
    return F.unhex(F.array_join(
        F.transform(bands, lambda band, i: F.when(i == 0, band).otherwise(F.concat(margin_rows, band))), ""
    ))


def png_header(width: Column, height: Column, colour_type: int) -> Column:
    """Signature and start of the first PNG block, up to the colour type."""
    def int32(value: Column) -> Column:
        return F.lpad(F.hex(value), 8, "0")
    block = F.concat(F.lit("0000000D"), F.hex(F.lit("IHDR")), int32(width), int32(height),
                     F.lit(f"08{colour_type:02X}"))
    return F.unhex(F.concat(F.lit(PNG_SIGNATURE), block))


def png_metadata(data: Column) -> dict[str, Column]:
    """width, height and components of a PNG, from its first block; NULL for other bytes."""
    is_png = F.hex(F.substring(data, 1, 8)) == PNG_SIGNATURE

    def number(position: int, length: int) -> Column:
        return F.when(is_png, F.conv(F.hex(F.substring(data, position, length)), 16, 10).cast("int"))

    components = F.create_map(*[F.lit(v) for pair in PNG_COMPONENTS.items() for v in pair])
    return {"width": number(17, 4), "height": number(21, 4),
            "components": F.try_element_at(components, number(26, 1))}


def describe(camera: Column, frame_number: Column, width: Column, height: Column, components: Column,
             n_bytes: Column) -> Column:
    return F.format_string("camera %d, frame %d, %dx%dx%d, %d bytes",
                           camera, frame_number, width, height, components, n_bytes)


def frame_name(camera: Column, frame_number: Column) -> Column:
    return F.format_string("camera-%03d-frame-%05d", camera, frame_number)
