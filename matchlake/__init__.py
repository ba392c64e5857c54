"""matchlake: match and player analytics as Spark jobs.

Bronze, silver and gold datasets of match records, with every step written as a
DataFrame or Spark SQL plan.
"""
