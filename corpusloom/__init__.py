"""corpusloom: a Spark engine for documentation corpora that are crawled again and again."""

from corpusloom.config import PipelineConfig
from corpusloom.session import get_session, materialize, shared_dir

__all__ = ["PipelineConfig", "get_session", "materialize", "shared_dir"]
