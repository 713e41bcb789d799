"""Settings of the anonymisation steps; the defaults are part of the semantics."""

from __future__ import annotations

from dataclasses import dataclass, fields, replace


@dataclass(frozen=True)
class PlateConfig:
    """Detection, temporal and blur settings of a plate step."""

    detection_conf_thresh: float = 0.18
    imgsz: int = 640
    detect_batch_size: int | None = None
    augment: bool = False
    secondary: bool = False
    secondary_imgsz: int | None = None
    secondary_conf_thresh: float | None = None
    secondary_batch_size: int | None = None
    secondary_augment: bool = True
    time_limit: float | None = None
    blur_radius: int = 31
    gap_fill_window: int = 5
    gap_fill_mode: str = "interpolate"
    carry_forward_window: int = 2
    temporal_smoothing: bool = True
    smoothing_alpha: float = 0.55
    pad_px: float = 3.0
    pad_ratio: float = 0.12
    min_width: float = 28.0
    min_height: float = 14.0
    match_distance: float = 1.8
    match_iou: float = 0.0
    growth_gap: float = 0.6
    growth_carry: float = 0.5
    temporal_dedupe_iou: float = 0.35
    temporal_dedupe_distance: float = 0.6
    frame_dedupe_iou: float = 0.45
    frame_dedupe_distance: float = 0.7
    expand_left_px: int = 0
    expand_right_px: int = 0
    expand_top_px: int = 0
    expand_bottom_px: int = 0
    expand_x_ratio: float = 0.0
    expand_y_ratio: float = 0.0


CAR_PLATES = PlateConfig(
    detection_conf_thresh=0.18, imgsz=1920, detect_batch_size=8,
    secondary_imgsz=2560, secondary_conf_thresh=0.10, secondary_batch_size=4, gap_fill_window=18, carry_forward_window=4,
    smoothing_alpha=0.5, pad_px=4, pad_ratio=0.15, min_width=30, min_height=16, match_distance=2.0,
    growth_gap=0.75, growth_carry=0.65, temporal_dedupe_iou=0.3, temporal_dedupe_distance=0.8,
    frame_dedupe_iou=0.4, frame_dedupe_distance=0.75, expand_left_px=4, expand_right_px=4, expand_top_px=2,
    expand_bottom_px=6, expand_x_ratio=0.12, expand_y_ratio=0.16,
)
TRUCK_PLATES = PlateConfig(
    detection_conf_thresh=0.10, imgsz=5120, detect_batch_size=1,
    secondary_imgsz=5120, secondary_conf_thresh=0.07, secondary_batch_size=1, gap_fill_window=18, carry_forward_window=4,
    smoothing_alpha=0.45, pad_px=6, pad_ratio=0.18, min_width=40, min_height=20, match_distance=2.5,
    growth_gap=0.9, growth_carry=0.8, temporal_dedupe_iou=0.25, temporal_dedupe_distance=0.9,
    frame_dedupe_iou=0.35, frame_dedupe_distance=0.8, expand_left_px=6, expand_right_px=6, expand_top_px=4,
    expand_bottom_px=8, expand_x_ratio=0.12, expand_y_ratio=0.18,
)


@dataclass(frozen=True)
class FaceConfig:
    conf: float = 0.40
    imgsz: int = 1280
    batch: int = 4
    time_limit: float | None = None
    blur_radius: int = 31
    gap_fill_window: int = 5
    gap_fill_mode: str = "interpolate"


@dataclass(frozen=True)
class OverlayConfig:
    """Matching of videos to camera templates, with the pipeline's thresholds."""

    ncc_score: float = 0.15
    ncc_margin: float = 0.005
    fast_score: float = 0.30
    fast_margin: float = 0.005
    blur_radius: int = 30
    blur_power: int = 6
    pad: int = 6
    max_output_width: int = 1920
    fuzzy_min_chars: int = 3


OVERLAY_CLI = OverlayConfig(0.50, 0.02, 0.72, 0.015, 24, 4, 4)


# The names that settings files use for settings with other names here, and the keys
# of theirs that say where things are or how a run behaves, which callers handle.
FILE_KEYS = {
    "tta_augment": "augment",
    "secondary_detection_enabled": "secondary",
    "secondary_detection_conf_thresh": "secondary_conf_thresh",
    "secondary_tta_augment": "secondary_augment",
    "secondary_detect_batch_size": "secondary_batch_size",
    "temporal_smoothing_alpha": "smoothing_alpha",
    "stabilize_pad_px": "pad_px",
    "stabilize_pad_ratio": "pad_ratio",
    "stabilize_min_width": "min_width",
    "stabilize_min_height": "min_height",
    "stabilize_match_distance_ratio": "match_distance",
    "stabilize_match_iou": "match_iou",
    "gap_fill_distance_growth_per_frame": "growth_gap",
    "carry_distance_growth_per_frame": "growth_carry",
    "temporal_dedupe_distance_ratio": "temporal_dedupe_distance",
    "frame_dedupe_distance_ratio": "frame_dedupe_distance",
    "blur_expand_left_px": "expand_left_px",
    "blur_expand_right_px": "expand_right_px",
    "blur_expand_top_px": "expand_top_px",
    "blur_expand_bottom_px": "expand_bottom_px",
    "blur_expand_x_ratio": "expand_x_ratio",
    "blur_expand_y_ratio": "expand_y_ratio",
}
FACE_KEYS = {"detection_conf_thresh": "conf", "detect_batch_size": "batch"}
RUN_KEYS = (
    "model_path videos_path output_folder output_dir gpu_avail generate_detections generate_jsons save_frames "
    "debug_keep_artifacts debug_log_details allow_cpu_fallback_on_detection_failure"
).split()


def configure(default, file_values: dict | None = None, **given):
    """A setting given explicitly wins over one from a file, and that over the default; None counts as not given.

    Files may use the names of FILE_KEYS (FACE_KEYS for faces). Keys of RUN_KEYS are passed over; any other unknown one
    raises, so that no setting is lost silently.
    """
    known = {f.name for f in fields(default)}
    names = FACE_KEYS if isinstance(default, FaceConfig) else FILE_KEYS
    chosen, unknown = {}, []
    for source in (file_values or {}, given):
        for key, value in source.items():
            name = names.get(key, key)
            if name in known:
                chosen |= {} if value is None else {name: value}
            elif key not in RUN_KEYS:
                unknown.append(key)
    if unknown:
        raise ValueError(f"unknown settings: {', '.join(sorted(unknown))}")
    return replace(default, **chosen)


def load_yaml(path: str) -> dict:
    """Values of a YAML file of scalar keys."""
    import yaml

    with open(path, encoding="utf-8") as f:
        return yaml.safe_load(f) or {}
