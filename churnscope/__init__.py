"""churnscope: customer-lifecycle analytics as Spark DataFrame plans.

Every operator is a function DataFrame(s) -> DataFrame that builds a lazy
plan; nothing customer-grained is collected to the driver.  Sub-packages:

* ``sources``   - raw table readers, conforming to the four input tables,
                  staging casts, layer writes and reloads
* ``functions`` - reusable column expressions and distributed exact
                  order statistics / ranking primitives
* ``operators`` - data quality, feature table, exploration, preparation,
                  scoring, cohort targeting, scenarios, calendar spine
* ``plans``     - the end-to-end pipeline and the query registry
"""

__version__ = "0.1.0"
