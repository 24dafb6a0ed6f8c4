"""corpusflow: preparing chat-format fine-tuning corpora with Spark."""

from corpusflow.config import CorpusConfig, DatasetConfig, SourceConfig

__all__ = ["CorpusConfig", "DatasetConfig", "SourceConfig"]
