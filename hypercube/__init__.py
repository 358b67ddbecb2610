"""hypercube: Spark-native analytics for large building-energy parametric studies.

A study draws a stratified (Latin Hypercube) design matrix, edits a building
model per design row, simulates each run, and turns the wide hourly outputs
into a sparse long fact table with run, zone and calendar dimensions.  This
package holds the analytic parts of that workflow as DataFrame functions:
every public operator takes DataFrames and returns a DataFrame, with the
physical plan left to Catalyst and AQE.

Layout
------
functions/  column expressions (rounding, hour-24 timestamps, schedules,
            identifier normalisation, polygon geometry, layer lists)
sources/    readers and writers (CSV groups with drifting headers, raw
            simulator output, nested JSON model documents, test fixtures)
operators/  relational operators (zones, sampling, scenario edits, hourly
            marts, run marts, timing marts, data-quality audits)
plans/      the published bundle (dashboard tables and views, manifest) and
            the registry of named queries
streaming/  Structured Streaming versions of progress and incremental stats
"""

from hypercube.session import get_session, work_dir

__all__ = ["get_session", "work_dir"]
