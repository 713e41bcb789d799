"""Argument lists of the external encoder, as Columns: one row, one call.

The flags and their order are fixed values: they are the tool's syntax and decide the output.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TOOL = "ffmpeg"
_QUIET = ("-hide_banner", "-loglevel", "error")
_H264 = ("-c:v", "libx264", "-preset", "veryfast", "-crf", "18", "-pix_fmt", "yuv420p")
_FROM_FRAMES = ("-c:v", "libx264", "-pix_fmt", "yuv420p", "-crf", "23", "-preset", "medium")


def _arguments(*parts) -> Column:
    """Constants, Columns, and (condition, parts) that are there only where the condition holds."""
    lists = []
    for p in parts:
        if isinstance(p, tuple):
            condition, inner = p
            lists.append(F.when(condition, _arguments(*inner)).otherwise(F.array().cast("array<string>")))
        else:
            lists.append(F.array(F.lit(p) if isinstance(p, str) else p.cast("string")))
    return F.flatten(F.array(*lists))


def extract_frames(path: Column, fps: Column, pattern: Column, seconds: Column, tool: str = TOOL) -> Column:
    """A video to numbered images at its own rate, the first `seconds` of it if that is above 0."""
    return _arguments(tool, "-i", path, "-vf", F.concat(F.lit("fps="), fps.cast("string")), "-q:v", "2", (seconds > 0, ("-t", seconds)), "-y", pattern)


def encode_frames(pattern: Column, fps: Column, output: Column, tool: str = TOOL) -> Column:
    """Numbered images to a video."""
    return _arguments(tool, "-y", "-framerate", fps, "-i", pattern, *_FROM_FRAMES, output)


def transcode(path: Column, output: Column, tool: str = TOOL) -> Column:
    """An intermediate video to the final one."""
    return _arguments(tool, *_QUIET, "-y", "-i", path, *_H264, "-movflags", "+faststart", output)


def mask(path: Column, graph: Column, output: Column, overwrite: bool = True, audio: bool = True, tool: str = TOOL) -> Column:
    """A video through a filter graph, whose last label is mapped; audio, if there is any, is copied unless it's left out."""
    label = F.when(graph.endswith("[vpreview]"), "[vpreview]").otherwise("[vout]")
    sound = ("-map", "0:a?"), ("-c:a", "copy")
    return _arguments(tool, *_QUIET, "-y" if overwrite else "-n", "-i", path, "-filter_complex", graph, "-map", label, *(sound[0] if audio else ()), *_H264, *(sound[1] if audio else ("-an",)), "-movflags", "+faststart", output)
