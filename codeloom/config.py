"""Settings of the coding jobs. Every value can be overridden with ``dataclasses.replace``."""

from __future__ import annotations

from dataclasses import asdict, dataclass, field, fields, replace


@dataclass(frozen=True)
class CodingConfig:
    profile: str = "accuracy"
    seed: int = 42

    # answer dictionaries
    dict_purity: float = 0.90
    dict_min_count: int = 5
    industry_dict_purity: float = 0.90
    industry_dict_min_count: int = 5
    use_fuzzy: bool = False
    fuzzy_threshold: int = 93
    # None keeps every title: the segment join below needs no cap to stay cheap
    fuzzy_max_titles_per_bucket: int | None = None

    # nearest-neighbour vote and fusion
    use_semantic: bool = True
    semantic_k: int = 35
    semantic_min_similarity: float = 0.42
    semantic_min_confidence: float = 0.25
    semantic_weight: float = 0.85
    model_weight: float = 1.0
    codebook_weight: float = 0.60
    encoder_dims: int = 128

    # external chooser for low-confidence rows
    use_chooser: bool = False
    chooser_trigger_industry: float = 0.55
    chooser_trigger_occupation: float = 0.55
    # accepted answers of the chooser; None accepts all
    chooser_max_rows: int | None = None
    chooser_confidence: float = 0.72
    chooser_free_code: bool = False

    # ranked output
    topk_industry: int = 4
    topk_occupation: int = 4
    top_groups: int = 3

    # support thresholds
    min_industry_n: int = 3
    min_occupation_n: int = 3
    min_group_n: int = 3
    min_flat_rows: int = 50
    min_hier_rows: int = 100
    min_within_rows: int = 50
    min_exemplars: int = 5

    # model selection
    model_search: str = "max"
    folds_industry: int = 5
    folds_major: int = 5
    folds_within: int = 3
    ensemble_size: int = 3
    ensemble_power: float = 2.0
    search_trials_industry: int = 12
    search_trials_major: int = 8
    search_trials_within: int = 0
    candidate_models: tuple[str, ...] | None = None

    # features
    # None keeps every term that its counts allow
    max_word_terms: int | None = None
    max_char_terms: int | None = None
    word_min_count: int = 2
    char_min_count: int = 5
    doc_prop_max: float = 0.80
    latent_components: int = 128
    latent_hash_dims: int = 1024

    # estimators
    logistic_c: float = 1.0
    logistic_max_iter: int = 1500
    sgd_alpha: float = 1e-5
    sgd_max_iter: int = 2500
    svc_c: float = 1.0
    tree_count: int = 300
    tree_max_classes: int = 120
    tree_max_features: int = 180_000
    complement_alpha: float = 0.5

    # write-back
    min_write_confidence_industry: float = 0.0
    min_write_confidence_occupation: float = 0.0
    overwrite_all: bool = False
    overwrite_industry: bool = False
    overwrite_occupation: bool = False
    missing_industry_values: tuple[str, ...] = ()
    missing_occupation_values: tuple[int, ...] = ()

    @staticmethod
    def for_profile(profile: str, **overrides) -> "CodingConfig":
        """Defaults of the fast, robust and accuracy profiles, then explicit overrides."""
        presets = {
            "fast": dict(model_search="light", use_semantic=False, latent_components=0, ensemble_size=1,
                         search_trials_industry=0, search_trials_major=0, search_trials_within=0),
            "robust": dict(model_search="robust", latent_components=64,
                           search_trials_industry=0, search_trials_major=0),
            "accuracy": dict(),
        }
        if profile not in presets:
            raise ValueError(f"unknown profile {profile!r}; expected one of {sorted(presets)}")
        return replace(CodingConfig(profile=profile), **{**presets[profile], **overrides})

    def to_dict(self) -> dict:
        return asdict(self)

    @staticmethod
    def from_dict(values: dict) -> "CodingConfig":
        known = {f.name for f in fields(CodingConfig)}
        clean = {k: tuple(v) if isinstance(v, list) else v for k, v in values.items() if k in known}
        return CodingConfig(**clean)

    # Settings the caller may still change when scoring with a saved bundle.
    SCORE_TIME = ("min_write_confidence_industry", "min_write_confidence_occupation",
                  "overwrite_all", "overwrite_industry", "overwrite_occupation",
                  "use_chooser", "chooser_max_rows", "missing_industry_values", "missing_occupation_values")

    def at_score_time(self, caller: "CodingConfig") -> "CodingConfig":
        """The saved configuration wins, except for the write-side settings."""
        return replace(self, **{name: getattr(caller, name) for name in self.SCORE_TIME})


@dataclass(frozen=True)
class SurveyColumns:
    """Column names of a survey table; the defaults are the published questionnaire names."""

    id: str = "id"
    employer: str = "qa20"
    industry_code: str = "qa20a"
    title: str = "qe4"
    title_code: str = "qe4ar"
    unused_title: str = "qe5a"
    unused_title_code: str = "qe5ar"
    industry_other: str = "qe1oth"
    selfemp_other: str = "qe8aoth"

    @property
    def prefixes(self) -> dict[str, str]:
        return {
            self.title: "JOBTITLE:",
            self.unused_title: "UNUSEDSKILL_TITLE:",
            self.employer: "EMPLOYER:",
            self.industry_code: "NAICS:",
            self.industry_other: "INDUSTRY_OTHER:",
            self.selfemp_other: "SELFEMP_OTHER:",
            "qe2b": "WORKCITY:",
            "qa9a": "ED_FIELD:",
            "qa9c1": "CERT:", "qa9c2": "CERT:", "qa9c3": "CERT:", "qa9c4": "CERT:",
            "qa9g": "LICENSE:",
            "qe13oth": "PAYTYPE_OTHER:",
        }

    @property
    def key_specs(self) -> tuple[tuple[str, tuple[str, ...]], ...]:
        """Industry dictionary keys, in priority order."""
        return (
            ("employer", (self.employer,)),
            ("employer_title", (self.employer, self.title)),
            ("industry_other", (self.industry_other,)),
            ("selfemp_other", (self.selfemp_other,)),
            ("title_industry", (self.title, self.industry_other)),
        )

    def industry(self) -> "TargetSpec":
        return TargetSpec(
            name="naics", target=self.industry_code, title=self.title,
            text=(self.employer, self.title, self.unused_title, self.industry_other, self.selfemp_other, "qe2b"),
            categories=("qe1", "qse1", "qe8a", "wh2", "qe8", "qa9", "qa9ar", "qe13", "qa6"),
            numbers=("qe10",), columns=self)

    def occupation(self) -> "TargetSpec":
        return TargetSpec(
            name=self.title_code, target=self.title_code, title=self.title,
            text=(self.title, *self._shared_text, self.industry_code),
            categories=(self.industry_code, "qe1", "qse1", "qe8a", "wh2", "qe8", "qa9", "qa9ar", "qe13", "qa6"),
            numbers=("qe10",), columns=self)

    def unused_occupation(self) -> "TargetSpec":
        return TargetSpec(
            name=self.unused_title_code, target=self.unused_title_code, title=self.unused_title,
            text=(self.unused_title, *self._shared_text, self.industry_code),
            categories=(self.industry_code, "qe1", "qa9", "qa9ar"),
            numbers=("qe10",), columns=self)

    @property
    def _shared_text(self) -> tuple[str, ...]:
        return (self.employer, self.industry_other, self.selfemp_other, "qe2b", "qa9a",
                "qa9c1", "qa9c2", "qa9c3", "qa9c4", "qa9g", "qe13oth")


@dataclass(frozen=True)
class TargetSpec:
    """Which columns feed one target."""

    name: str
    target: str
    title: str
    text: tuple[str, ...]
    categories: tuple[str, ...]
    numbers: tuple[str, ...]
    columns: SurveyColumns = field(default_factory=SurveyColumns)

    @property
    def prefixes(self) -> dict[str, str]:
        return self.columns.prefixes
