"""Plan shapes chosen for scale (see README §Scale):

* ``ranged``  — order-dependent windows without a single global task:
  range buckets from approximate quantiles, windows per bucket, and a small
  edge table carried across bucket borders.
* ``inspect`` — helpers to read a physical plan in tests.
"""
