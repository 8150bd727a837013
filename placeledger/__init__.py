"""DataFrame operators for crawled business listings.

`functions` holds Column expressions, `operators` DataFrame-to-DataFrame steps,
`sources` readers, dimensions and sinks, `plans` whole flows built from operators,
`streaming` the incremental forms.
"""
