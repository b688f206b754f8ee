"""crashgrid: incident analytics as Spark DataFrame plans.

* ``crashgrid.sources``   - collision-table contract, readers, driver-table adapters, sinks
* ``crashgrid.functions`` - enrichment expressions, predicates, labels, small dimensions
* ``crashgrid.operators`` - roll-ups, peaks and top-N, trends, matrices, joins
* ``crashgrid.plans``     - the named results, query registry, one-pass runs
* ``crashgrid.streaming`` - the count roll-ups over arriving files
"""

__version__ = "0.1.0"
