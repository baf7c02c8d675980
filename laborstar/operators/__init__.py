"""DataFrame -> DataFrame operators: headers, cleaning, transforms, checks."""
