"""Run parameters and results."""

from dataclasses import dataclass, field

ENVIRONMENTS = ("dev", "test", "prod")


@dataclass(frozen=True)
class RunConfig:
    """Where the lake lives and which window of call dates a run covers.

    ``{env}`` in ``base`` stands for the environment, so that one set of parameters serves
    all of them.  ``source_folder`` and ``sink_folder`` name the folders of raw files and of
    Silver.  With ``debug`` a run logs every figure of its result, otherwise one line.
    """

    base: str
    window_start: str = "1900-01-01"
    window_end: str = "9999-12-31"
    env: str = "dev"
    database: str | None = None
    source_folder: str = "bronze"
    sink_folder: str = "silver"
    debug: bool = False

    def __post_init__(self):
        if self.env not in ENVIRONMENTS:
            raise ValueError(f"env must be one of {', '.join(ENVIRONMENTS)}, not {self.env!r}")
        object.__setattr__(self, "base", self.base.replace("{env}", self.env))

    def layer(self, name: str) -> str:
        return self.sink_folder if name == "silver" else name

    def bronze(self, name: str) -> str:
        return f"{self.base}/{self.source_folder}/{name}"

    def path(self, layer: str, name: str) -> str:
        return f"{self.base}/{self.layer(layer)}/{name}"


@dataclass
class RunResult:
    """What a run hands back: status, row counts per table and quality figures."""

    status: str = "SUCCESS"
    rows_read: dict[str, int] = field(default_factory=dict)
    rows_written: dict[str, int] = field(default_factory=dict)
    quality: dict[str, int] = field(default_factory=dict)
    detail: dict = field(default_factory=dict)
