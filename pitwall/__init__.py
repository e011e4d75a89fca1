"""pitwall — race-entry analytics as lazy Spark DataFrame jobs.

Every public function takes and returns DataFrames (or small driver-side
metadata such as a fitted model) and never pulls a data-sized result to the
driver.  Sub-packages:

* ``sources``   — scans: the race-table rig over the TPC-H-style tables,
                  CSV/JSON/binary/HTML readers, sinks.
* ``functions`` — scalar column expressions (time parsing, name cleaning, ...).
* ``operators`` — filters, contracts, joins, aggregates, windows, sampling,
                  reshaping, calibration, clustering, trees, attribution.
* ``plans``     — composite jobs (race prediction, scoring, training, ...).
* ``streaming`` — the stateless scoring plan over ``readStream`` input.
"""

__version__ = "0.1.0"
