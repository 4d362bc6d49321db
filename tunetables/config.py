"""Scorer options: frozen dataclasses, checked when built, no Spark work."""

from __future__ import annotations

import math
from dataclasses import dataclass, field, fields


def _unit(owner: str, **values: float) -> None:
    for name, value in values.items():
        ok = isinstance(value, (int, float)) and not isinstance(value, bool)
        if not ok or not math.isfinite(value) or not 0.0 <= value <= 1.0:
            raise ValueError(f"{owner}.{name} must be a finite number in [0, 1], got {value!r}")


def _aliases(owner: str, table: dict[str, tuple[str, ...]], required: tuple[str, ...]) -> None:
    for key in required:
        names = table.get(key)
        if not names or isinstance(names, str) or any(not n.strip() for n in names):
            raise ValueError(f"{owner}.{key} needs a non-empty list of names")


def float_suffix(value: float) -> str:
    """0.5 -> '0p5', 1.0 -> '1': the spelling used in reward names."""
    return f"{value:g}".replace(".", "p")


# Option names and defaults are the public configuration.
@dataclass(frozen=True)
class Extraction:
    """How the answer is cut out of a completion."""

    is_answer_tag: bool = False
    think_start_token: str = "<think>"
    think_end_token: str = "</think>"
    answer_start_token: str = "<answer>"
    answer_end_token: str = "</answer>"
    eos_token: str = "<|im_end|>"
    extraction_profile: str = "default"
    #: False inserts the tags into patterns as they are, so a tag holding regex
    #: characters (the default eos) acts as a pattern; True quotes them.
    escape_tags: bool = False

    def __post_init__(self) -> None:
        if self.extraction_profile not in ("default", "gemma4"):
            raise ValueError(f"unsupported extraction profile: {self.extraction_profile}")


# Option names and defaults are the public configuration.
@dataclass(frozen=True)
class MatchOptions:
    incorrect_penalty: float = 0.0

    @property
    def name(self) -> str:
        if self.incorrect_penalty <= 0:
            return "match_reward"
        return f"match_reward_neg{float_suffix(self.incorrect_penalty)}"


# Option names and defaults are the public configuration.
@dataclass(frozen=True)
class CodeOptions:
    wrong_output_penalty: float = 0.0
    non_executable_penalty: float = 0.0

    @property
    def name(self) -> str:
        if self.wrong_output_penalty <= 0 and self.non_executable_penalty <= 0:
            return "code_execution_reward"
        return (
            f"code_execution_reward_negw{float_suffix(self.wrong_output_penalty)}"
            f"_negx{float_suffix(self.non_executable_penalty)}"
        )


# Option names and defaults are the public configuration.
@dataclass(frozen=True)
class RougeOptions:
    type: str = "l"
    stem: bool = True

    def __post_init__(self) -> None:
        if self.type not in ("1", "2", "l"):
            raise ValueError("rouge type must be '1', '2' or 'l'")

    @property
    def name(self) -> str:
        return f"rouge_{self.type}_reward"


@dataclass(frozen=True)
class Stage:
    k: int
    bonus: float
    drop: float


# Option names and defaults are the public configuration.
@dataclass(frozen=True)
class HitOptions:
    top_k: int = 250
    shaping_weight: float = 1.0
    rank_margin: int = 0
    stages: tuple[Stage, ...] = (Stage(20, 0.10, 0.10), Stage(10, 0.30, 0.30), Stage(5, 0.50, 0.50))

    def __post_init__(self) -> None:
        if self.top_k <= 0 or self.shaping_weight < 0 or self.rank_margin < 0:
            raise ValueError("top_k must be >= 1, shaping_weight and rank_margin >= 0")
        if not self.stages:
            raise ValueError("stages must not be empty")
        for i, stage in enumerate(self.stages):
            if not isinstance(stage.k, int) or not 1 <= stage.k <= self.top_k:
                raise ValueError(f"stage {i}: k must be an int in 1..{self.top_k}")
            if stage.bonus < 0 or stage.drop < 0:
                raise ValueError(f"stage {i}: bonus and drop must be >= 0")
        for wide, tight in zip(self.stages, self.stages[1:]):
            if tight.k > wide.k or tight.bonus < wide.bonus or tight.drop < wide.drop:
                raise ValueError("stages: k must not rise, bonus and drop must not fall")

    @property
    def name(self) -> str:
        ks = ",".join(str(s.k) for s in self.stages)
        return f"retrieval_hit@{self.top_k}_stages[{ks}]_reward"


# Option names and defaults are the public configuration.
@dataclass(frozen=True)
class NdcgOptions:
    top_k: int | None = None
    reward_mode: str = "relative"
    top_ks: tuple[int, ...] = (1, 3, 5, 10)
    alpha: float = 0.5
    weighting_mode: str = "large_k"
    epsilon: float = 1.0e-8

    def __post_init__(self) -> None:
        if self.reward_mode not in ("relative", "absolute"):
            raise ValueError("reward_mode must be 'relative' or 'absolute'")
        if self.weighting_mode not in ("small_k", "large_k"):
            raise ValueError("weighting_mode must be 'small_k' or 'large_k'")
        if self.alpha < 0 or (self.reward_mode == "relative" and self.epsilon <= 0):
            raise ValueError("alpha must be >= 0 and epsilon > 0")
        if not self.top_ks or any(k < 1 for k in self.top_ks):
            raise ValueError("top_ks must be positive ints")
        if any(b <= a for a, b in zip(self.top_ks, self.top_ks[1:])):
            raise ValueError("top_ks must rise strictly")
        if self.top_k is not None and self.top_k < max(self.top_ks):
            raise ValueError("top_k must reach the largest cutoff")

    @property
    def depth(self) -> int:
        return self.top_k or max(self.top_ks)

    @property
    def weights(self) -> list[float]:
        sign = -1.0 if self.weighting_mode == "small_k" else 1.0
        raw = [float(k) ** (sign * self.alpha) for k in self.top_ks]
        return [w / sum(raw) for w in raw]

    @property
    def name(self) -> str:
        ks = ",".join(str(k) for k in self.top_ks)
        return f"retrieval_ndcg@{ks}_{self.reward_mode}_{self.weighting_mode}_reward"


# Option names and defaults are the public configuration.
@dataclass(frozen=True)
class KVOptions:
    category_token: str = "kv"
    strict_json: bool = True
    required_stop_token: str = "<stop>"
    invalid_json_reward: float = 0.0
    root_mismatch_cap: float = 0.2
    missing_stop_cap: float = 0.6
    middle_or_multiple_stop_cap: float = 0.2
    trailing_text_cap: float = 0.2
    max_serialized_length_ratio: float = 2.0
    length_ratio_cap: float = 0.7
    max_leaf_count_ratio: float = 1.5
    leaf_count_ratio_cap: float = 0.7
    kv_value_weight: float = 0.5
    kv_path_weight: float = 0.5
    table_value_weight: float = 0.4
    table_structure_weight: float = 0.6
    table_name_mismatch_cap: float = 0.4
    table_column_mismatch_cap: float = 0.5
    table_row_count_mismatch_cap: float = 0.6
    kv_top_level_path_mismatch_cap: float = 0.5
    extra_leaf_ratio_threshold: float = 0.2
    extra_leaf_cap: float = 0.6
    missing_leaf_ratio_threshold: float = 0.2
    missing_leaf_cap: float = 0.6
    duplicate_value_cap: float = 0.6
    duplicate_path_cap: float = 0.6
    duplicate_table_row_cap: float = 0.6
    use_weighted_fuzzy_f1: bool = True
    weighted_fuzzy_match_threshold: float = 0.5
    normalized_match_cap: float = 0.5
    coarse_match_cap: float = 0.5
    non_exact_value_cap: float = 0.5
    empty_value_mismatch_cap: float = 0.0
    numeric_punctuation_mismatch_cap: float = 0.5
    score_threshold: float = 0.95
    allowed_sibling_keys: tuple[str, ...] = ("grounding",)

    def __post_init__(self) -> None:
        if not self.category_token.strip() or not self.required_stop_token:
            raise ValueError("category_token and required_stop_token must not be empty")
        if isinstance(self.allowed_sibling_keys, str) or any(not s or s != s.strip() for s in self.allowed_sibling_keys):
            raise ValueError("allowed_sibling_keys must be stripped non-empty names")
        skip = {"category_token", "strict_json", "required_stop_token", "max_serialized_length_ratio", "max_leaf_count_ratio", "use_weighted_fuzzy_f1", "allowed_sibling_keys"}
        _unit("kv", **{k: v for k, v in self.__dict__.items() if k not in skip})
        for name in ("max_serialized_length_ratio", "max_leaf_count_ratio"):
            value = getattr(self, name)
            if not math.isfinite(value) or value <= 0:
                raise ValueError(f"kv.{name} must be a positive finite number")
        for a, b in (("kv_value_weight", "kv_path_weight"), ("table_value_weight", "table_structure_weight")):
            if not math.isclose(getattr(self, a) + getattr(self, b), 1.0, rel_tol=1e-6, abs_tol=1e-6):
                raise ValueError(f"kv.{a} + {b} must equal 1")

    @property
    def threshold(self) -> float:
        return self.weighted_fuzzy_match_threshold if self.use_weighted_fuzzy_f1 else self.score_threshold

    name = "kv_reward"


# The default JSON field names of grounding documents.
BOX_KEYS: dict[str, tuple[str, ...]] = {
    "field_path": ("field_path",),
    "value_index": ("value_index",),
    "grounding_status": ("grounding_status",),
    "prediction_occurrences": ("evidence_occurrences", "positive_occurrences", "occurrences"),
    "label_occurrences": ("positive_occurrences", "evidence_occurrences", "occurrences"),
    "hard_negative_evidence": ("hard_negative_evidence",),
    "fragments": ("fragments",),
    "page": ("page",),
    "bbox": ("bbox",),
    "envelope_bbox": ("envelope_bbox", "bbox"),
    "coord_system": ("coord_system",),
}
STATUS_VALUES: dict[str, tuple[str, ...]] = {
    "found": ("found",),
    "not_found": ("not_found", "missing", "absent"),
}
SELECTION_KEYS: dict[str, tuple[str, ...]] = {
    "items": ("grounding",),
    "target_id": ("target_id",),
    "selected_ids": ("selected_ids", "selected_candidate_ids"),
}


# Option names and defaults are the public configuration.
@dataclass(frozen=True)
class BBoxOptions:
    category_token: str = "bbox"
    format_reward: float = 0.1
    schema_reward: float = 0.1
    page_reward: float = 0.2
    iou_weight: float = 0.5
    iou_05_threshold: float = 0.5
    iou_05_bonus: float = 0.3
    iou_07_threshold: float = 0.7
    iou_07_bonus: float = 0.2
    center_in_gt_bonus: float = 0.1
    large_box_area_threshold: float = 0.25
    large_box_penalty: float = -0.2
    hard_negative_iou_threshold: float = 0.5
    hard_negative_overlap_penalty: float = -0.3
    positive_duplicate_iou_threshold: float = 0.95
    schema_keys: dict[str, tuple[str, ...]] = field(default_factory=lambda: dict(BOX_KEYS))
    status_values: dict[str, tuple[str, ...]] = field(default_factory=lambda: dict(STATUS_VALUES))
    min_reward: float = 0.0
    max_reward: float = 1.0

    def __post_init__(self) -> None:
        _aliases("grounding_bbox.schema_keys", self.schema_keys, tuple(BOX_KEYS))
        _aliases("grounding_bbox.status_values", self.status_values, tuple(STATUS_VALUES))

    name = "grounding_bbox_reward"


# Option names and defaults are the public configuration.
@dataclass(frozen=True)
class SelectionOptions:
    category_token: str = "evidence"
    format_reward: float = 0.1
    schema_reward: float = 0.1
    exact_match_reward: float = 0.6
    partial_match_weight: float = 0.6
    over_selection_penalty: float = -0.2
    wrong_selection_penalty: float = -0.3
    partial_match_cap: float = 1.0
    multi_fragment_partial_match_cap: float = 1.0
    missing_gold_id_penalty: float = 0.0
    single_id_partial_cap: float = 1.0
    short_multi_id_partial_cap: float = 1.0
    long_multi_id_partial_cap: float = 1.0
    very_long_multi_id_partial_cap: float = 1.0
    over_selection_cap: float = 1.0
    wrong_occurrence_cap: float = 1.0
    wrong_occurrence_overlap_threshold: float = 0.0
    extra_selected_id_penalty: float = 0.0
    schema_only_reward_cap: float = 1.0
    empty_selection_reward_cap: float = 1.0
    invalid_schema_reward_cap: float = 1.0
    extra_target_reward_cap: float = 1.0
    target_quality_aggregation: str = "mean"
    hard_target_min_gold_ids: int = 5
    hard_target_weight: float = 1.0
    min_reward: float = 0.0
    max_reward: float = 1.0
    schema_keys: dict[str, tuple[str, ...]] = field(default_factory=lambda: dict(SELECTION_KEYS))

    def __post_init__(self) -> None:
        if self.target_quality_aggregation not in ("mean", "min", "hard_weighted_mean"):
            raise ValueError("target_quality_aggregation must be mean, min or hard_weighted_mean")
        _aliases("grounding_selection.schema_keys", self.schema_keys, tuple(SELECTION_KEYS))

    name = "grounding_selection_reward"


#: reward -> (path of its options in a configuration, their class)
SECTIONS: dict[str, tuple[tuple[str, ...], type]] = {
    "match": (("match",), MatchOptions),
    "code_execution": (("code_execution",), CodeOptions),
    "rouge": (("rouge",), RougeOptions),
    "retrieval_hit": (("retrieval", "hit"), HitOptions),
    "retrieval_ndcg": (("retrieval", "ndcg"), NdcgOptions),
    "kv": (("kv",), KVOptions),
    "grounding_bbox": (("grounding_bbox",), BBoxOptions),
    "grounding_selection": (("grounding_selection",), SelectionOptions),
}


def _frozen(value):
    """Lists of a configuration as tuples, at any depth."""
    if isinstance(value, (list, tuple)):
        return tuple(Stage(**v) if isinstance(v, dict) else _frozen(v) for v in value)
    if isinstance(value, dict):
        return {k: _frozen(v) for k, v in value.items()}
    return value


def options_from(config: dict, reward: str):
    """The checked options of one reward from a nested mapping of public names.
    Names that the options do not have (device settings, column names) are skipped."""
    path, kind = SECTIONS[reward]
    section = config
    for step in path:
        section = section.get(step) or {}
    known = {f.name for f in fields(kind)}
    return kind(**{k: _frozen(v) for k, v in section.items() if k in known})


def extraction_from(config: dict) -> Extraction:
    known = {f.name for f in fields(Extraction)}
    return Extraction(**{k: v for k, v in config.items() if k in known})


def active_weights(config: dict) -> dict[str, float]:
    """The rewards of a mapping's ``weight`` block that take part."""
    return {name: float(w) for name, w in (config.get("weight") or {}).items() if w and float(w) > 0}
