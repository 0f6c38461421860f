"""Pixel column functions: bytes to hex pixels, pixels to basic color names."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyspark.functions.numeric import _col

# Channel thresholds, opacity limit, and the basic color names in
# natural order of (red, green, blue) levels, each level being 0, 128 or 255.
LOW_BELOW = 85
MIDDLE_BELOW = 170
OPAQUE_FROM = 128
NO_COLOR = "None"
COLOR_NAMES = [
    "Black", "Blue", "Blue",
    "Green", "Green", "Blue",
    "Green", "Green", "Blue",
    "Red", "Purple", "Purple",
    "Green", "Gray", "Purple",
    "Green", "Green", "Blue",
    "Red", "Pink", "Purple",
    "Orange", "Orange", "Pink",
    "Yellow", "Yellow", "White",
]
PIXEL_COLORS = sorted({*COLOR_NAMES, NO_COLOR})


def pixel_hex(data, index, channels) -> Column:
    """Pixel number ``index`` (from 0) of a byte string as upper-case hex."""
    channels = channels if isinstance(channels, Column) else F.lit(channels)
    return F.hex(F.substring(_col(data), index * channels + F.lit(1), channels))


def _color_number(red, green, blue, alpha, byte) -> Column:
    """Index into ``PIXEL_COLORS`` of a pixel; ``byte`` makes the text of a value that the
    channels can be compared with."""

    def level(channel: Column) -> Column:
        return F.when(channel < byte(LOW_BELOW), 0).when(channel < byte(MIDDLE_BELOW), 1).otherwise(2)

    names = F.array(*[F.lit(PIXEL_COLORS.index(n)) for n in COLOR_NAMES])
    named = F.element_at(names, level(red) * 9 + level(green) * 3 + level(blue) + 1)
    return F.when(alpha >= byte(OPAQUE_FROM), named).otherwise(F.lit(PIXEL_COLORS.index(NO_COLOR)))


PIXELS_AT_ONCE = 1 << 18
_LEVELS = np.digitize(np.arange(256), [LOW_BELOW, MIDDLE_BELOW])
_NUMBERS = np.array([PIXEL_COLORS.index(n) for n in COLOR_NAMES], np.int64)


def color_histogram(data: bytes) -> np.ndarray:
    """How many pixels of blue-green-red-alpha bytes have each color of ``PIXEL_COLORS``.

    Each pixel becomes one small number, and these are counted; a portion of
    ``PIXELS_AT_ONCE`` at a time, so memory does not grow with the image.
    """
    pixels = np.frombuffer(data, np.uint8)[: len(data) // 4 * 4].reshape(-1, 4)
    counts = np.zeros(len(PIXEL_COLORS), np.int64)
    for start in range(0, len(pixels), PIXELS_AT_ONCE):
        blue, green, red, alpha = pixels[start : start + PIXELS_AT_ONCE].T
        symbols = _NUMBERS[_LEVELS[red] * 9 + _LEVELS[green] * 3 + _LEVELS[blue]]
        symbols[alpha < OPAQUE_FROM] = PIXEL_COLORS.index(NO_COLOR)
        counts += np.bincount(symbols, minlength=len(counts))
    return counts


def color_number(data, index) -> Column:
    """Color index of pixel ``index`` (from 0) of blue-green-red-alpha bytes, for single pixels.

    Single bytes are compared as they are; no text is made.
    """

    def channel(place: int) -> Column:
        return F.substring(_col(data), index * 4 + F.lit(place), F.lit(1))

    return _color_number(channel(3), channel(2), channel(1), channel(4), lambda v: F.lit(bytes([v])))


def color_of_number(number) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in PIXEL_COLORS]), _col(number) + 1)


def color_name(pixel) -> Column:
    """Basic color of a pixel given as hex text in blue-green-red-alpha order.

    Less than half opaque, malformed and NULL pixels are ``"None"``. Hex digits
    of one case sort like the numbers they stand for.
    """
    text = F.upper(_col(pixel))

    def channel(place: int) -> Column:
        return F.substring(text, 2 * place - 1, 2)

    number = _color_number(channel(3), channel(2), channel(1), channel(4), lambda v: F.lit(f"{v:02X}"))
    return F.when(text.rlike("^[0-9A-F]{8}"), color_of_number(number)).otherwise(F.lit(NO_COLOR))
