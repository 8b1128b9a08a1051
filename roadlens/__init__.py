"""roadlens — Spark-native operators for vehicle-camera logs, text lines and
ego-list relationship data.

Every public operator takes DataFrames plus parameters and returns a lazy
DataFrame; nothing is collected to the driver.  Sub-packages:

* ``roadlens.sources``    loaders (text, TSV logs, relationship file, streams)
                          and the role bindings onto the driver tables
* ``roadlens.functions``  column-level helpers (Java-style split, log time,
                          hour of day, truncating average, congestion level)
* ``roadlens.operators``  the batch operators (text, graph, traffic, windows)
* ``roadlens.plans``      reusable physical building blocks (skew-safe
                          ordered sequences, checked broadcast, checkpoint dir)
* ``roadlens.streaming``  Structured Streaming forms and foreachBatch sinks
"""

__version__ = "0.1.0"
