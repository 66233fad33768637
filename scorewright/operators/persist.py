"""Persistence of fitted objects (S9): Spark ML models with a writer and a reader.

A fitted object of this library is made of plain values (medians, weights, positions) and
of other models.  ``Saved`` writes the values into the metadata that Spark ML keeps for each
stage, and each part into a folder of its own by that part's writer; reading goes by the
class named in the metadata.  So a saved object may hold Spark's models and this library's
in any depth, and a ``PipelineModel`` may hold ``Saved`` stages.
"""

from __future__ import annotations

from pyspark.ml import Model, Transformer
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter


class Saved(Model, MLWritable, MLReadable):
    """A fitted object; subclasses give ``state`` (JSON values), ``parts`` (models) and ``rebuild``."""

    def state(self) -> dict:
        return {}

    def parts(self) -> dict[str, Transformer]:
        return {}

    @classmethod
    def rebuild(cls, state: dict, parts: dict[str, Transformer]) -> "Saved":
        raise NotImplementedError

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader()


class _Writer(MLWriter):
    def __init__(self, fitted: Saved):
        super().__init__()
        self.fitted = fitted

    def saveImpl(self, path: str) -> None:
        parts = self.fitted.parts()
        DefaultParamsWriter.saveMetadata(self.fitted, path, self.sparkSession, {"state": self.fitted.state(), "parts": list(parts)})
        for name, part in parts.items():
            part.write().save(f"{path}/parts/{name}")


class _Reader(MLReader):
    def load(self, path: str) -> Saved:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        parts = {name: DefaultParamsReader.loadParamsInstance(f"{path}/parts/{name}", self.sparkSession) for name in metadata["parts"]}
        module, _, name = metadata["class"].rpartition(".")
        fitted = getattr(__import__(module, fromlist=[name]), name).rebuild(metadata["state"], parts)
        fitted._resetUid(metadata["uid"])
        return fitted


def save(fitted, path: str) -> None:
    """Write a fitted object or pipeline; a folder that is there is replaced."""
    fitted.write().overwrite().save(path)


def load(path: str):
    """The object that was saved at ``path``, whatever its class."""
    from pyspark.sql import SparkSession
    return DefaultParamsReader.loadParamsInstance(path, SparkSession.active())


def numbered(models) -> dict[str, Transformer]:
    return {str(i): m for i, m in enumerate(models)}


def in_order(parts: dict[str, Transformer], prefix: str = "") -> list[Transformer]:
    own = {int(name[len(prefix):]): m for name, m in parts.items() if name.startswith(prefix) and name[len(prefix):].isdigit()}
    return [own[i] for i in sorted(own)]
