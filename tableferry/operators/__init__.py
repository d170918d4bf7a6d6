"""Row work: conform, audit, layout, load.  DataFrame in, DataFrame out."""
