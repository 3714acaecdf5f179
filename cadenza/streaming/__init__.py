"""Streaming: nothing to build.

The workloads this library covers are bounded: no event time, state or late
data. Every feature stage and fitted model is a pure column expression, so
a fitted ``PipelineModel`` applies unchanged to a Structured Streaming
DataFrame (``model.transform(spark.readStream...)``); no streaming-specific
operator is needed or provided.
"""
