"""Configuration of a pipeline run."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class PipelineConfig:
    """Everything a run needs to know; addresses are parameters, not constants of the engine."""

    scope_prefix: str = "https://developer.pomology.example/"
    video_prefix: str = "https://developer.pomology.example/videos/play/"
    video_path: str = "/videos/play/"
    origin: str = "https://developer.pomology.example"
    document_paths: tuple[str, ...] = ("/documentation", "/design")
    api_default: str = "https://developer.pomology.example/tutorials/data"
    api_alternate: str = "https://swift.pomology.example/data/documentation"
    alternate_marker: str = "/documentation/docc"
    alternate_page: str = "https://developer.pomology.example/documentation/toolchain/formatting-your-content"
    alternate_page_from: str = "/documentation/toolchain"
    alternate_page_to: str = "/docc"
    batch_size: int | None = 30  # None: a batch takes every page in scope
    batch_count: int = 30
    worker: int = 0  # which of the workers that claim at once this one is
    workers: int = 1
    force_update_all: bool = False
    permanent_statuses: tuple[int, ...] = (403, 404, 410)
    chunk_target: int = 2500
    chunk_range: int = 250
    embedding_dim: int = 64
    headers: dict[str, str] = field(default_factory=lambda: {"Accept": "application/json"})

    @staticmethod
    def from_env(env: dict[str, str]) -> PipelineConfig:
        """Read ``BATCH_SIZE``, ``BATCH_COUNT``, ``WORKER``, ``WORKERS`` and ``FORCE_UPDATE_ALL``; blank values mean the default."""
        base = PipelineConfig()
        return PipelineConfig(
            batch_size=int(env.get("BATCH_SIZE") or base.batch_size),
            batch_count=int(env.get("BATCH_COUNT") or base.batch_count),
            worker=int(env.get("WORKER") or base.worker),
            workers=int(env.get("WORKERS") or base.workers),
            force_update_all=(env.get("FORCE_UPDATE_ALL") or "").lower() == "true",
        )
