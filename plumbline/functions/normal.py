"""Normal distribution as Column expressions, so row-level use stays in codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Hart's rational approximation of the upper normal tail.
HART_TOP = (3.52624965998911e-02, 0.700383064443688, 6.37396220353165, 33.912866078383,
            112.079291497871, 221.213596169931, 220.206867912376)
HART_BOTTOM = (8.83883476483184e-02, 1.75566716318264, 16.064177579207, 86.7807322029461,
               296.564248779674, 637.333633378831, 793.826512519948, 440.413735824752)

# Wichura's algorithm AS 241 (PPND16), highest power first.
CENTRE_TOP = (2.5090809287301226727e+3, 3.3430575583588128105e+4, 6.7265770927008700853e+4,
              4.5921953931549871457e+4, 1.3731693765509461125e+4, 1.9715909503065514427e+3,
              1.3314166789178437745e+2, 3.3871328727963666080e+0)
CENTRE_BOTTOM = (5.2264952788528545610e+3, 2.8729085735721942674e+4, 3.9307895800092710610e+4,
                 2.1213794301586595867e+4, 5.3941960214247511077e+3, 6.8718700749205790830e+2,
                 4.2313330701600911252e+1, 1.0)
MIDDLE_TOP = (7.74545014278341407640e-4, 2.27238449892691845833e-2, 2.41780725177450611770e-1,
              1.27045825245236838258e+0, 3.64784832476320460504e+0, 5.76949722146069140550e+0,
              4.63033784615654529590e+0, 1.42343711074968357734e+0)
MIDDLE_BOTTOM = (1.05075007164441684324e-9, 5.47593808499534494600e-4, 1.51986665636164571966e-2,
                 1.48103976427480074590e-1, 6.89767334985100004550e-1, 1.67638483018380384940e+0,
                 2.05319162663775882187e+0, 1.0)
FAR_TOP = (2.01033439929228813265e-7, 2.71155556874348757815e-5, 1.24266094738807843860e-3,
           2.65321895265761230930e-2, 2.96560571828504891230e-1, 1.78482653991729133580e+0,
           5.46378491116411436990e+0, 6.65790464350110377720e+0)
FAR_BOTTOM = (2.04426310338993978564e-15, 1.42151175831644588870e-7, 1.84631831751005468180e-5,
              7.86869131145613259100e-4, 1.48753612908506148525e-2, 1.36929880922735805310e-1,
              5.99832206555887937690e-1, 1.0)


def polynomial(x: Column, coefficients) -> Column:
    """Horner evaluation, highest power first."""
    total = F.lit(float(coefficients[0]))
    for c in coefficients[1:]:
        total = total * x + F.lit(float(c))
    return total


def normal_cdf(x: Column) -> Column:
    size = F.abs(x)
    bell = F.exp(-size * size / 2.0)
    near = bell * polynomial(size, HART_TOP) / polynomial(size, HART_BOTTOM)
    fraction = size + 0.65
    for step in (4.0, 3.0, 2.0, 1.0):
        fraction = size + F.lit(step) / fraction
    far = bell / fraction / 2.5066282746310002
    tail = F.when(size < 7.07106781186547, near).when(size <= 37.0, far).otherwise(0.0)
    return F.when(x > 0, 1.0 - tail).when(x.isNotNull(), tail)


def normal_ppf(p: Column) -> Column:
    """Inverse of the normal distribution function; null outside (0, 1)."""
    q = p - 0.5
    centred = F.lit(0.180625) - q * q
    inner = q * polynomial(centred, CENTRE_TOP) / polynomial(centred, CENTRE_BOTTOM)
    r = F.sqrt(-F.log(F.when(q < 0, p).otherwise(1.0 - p)))
    near, far = r - 1.6, r - 5.0
    outer = F.when(r <= 5.0, polynomial(near, MIDDLE_TOP) / polynomial(near, MIDDLE_BOTTOM)).otherwise(
        polynomial(far, FAR_TOP) / polynomial(far, FAR_BOTTOM))
    return F.when((p <= 0) | (p >= 1), F.lit(None).cast("double")).otherwise(
        F.when(F.abs(q) <= 0.425, inner).otherwise(F.when(q < 0, -outer).otherwise(outer)))


def normal_pdf(x: Column) -> Column:
    return F.exp(-x * x / 2.0) / 2.5066282746310002
