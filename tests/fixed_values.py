"""Inputs and expected results of the acceptance tests."""

# Percent returns of three assets over 60 months.
MONTHLY = {
    "asset1": [
        2.1675, 3.3875, -2.5194, -1.3959, -2.7264, 0.7832, 3.9749, -3.3869, -0.1714, 0.5439,
        1.0913, -1.0361, -0.871, 1.0377, -2.7236, 2.7485, -0.8348, -1.2728, -0.5232, 0.1174,
        1.1843, 0.6003, -0.5785, -1.8834, 1.0666, 3.7147, -0.3213, 1.3712, -0.7987, 0.949,
        -2.5322, 0.4613, -1.6205, 4.7482, 1.6551, -5.1563, -1.0738, -1.2798, -0.7793, -0.3613,
        0.1896, -2.6047, -3.1645, -0.6066, 0.8595, 3.642, 0.6684, 1.5556, 1.4717, -2.6414,
        -1.6742, 1.5918, -1.4625, 0.0491, -0.2674, 1.0214, 1.0679, -5.4239, 0.4125, 4.9665,
    ],
    "asset2": [
        -1.8883, -0.5608, 1.5773, 1.4225, 1.0408, 1.2914, -0.2969, 0.6602, 0.2207, 0.3632,
        0.103, -0.5964, 2.2177, 0.2439, 2.7658, -1.4885, -1.3056, 2.2504, 1.8409, 0.9127,
        1.6094, -0.1249, -0.2565, 0.5511, -0.555, 0.2948, 0.8969, -0.6688, -0.0603, -0.0582,
        3.4582, 1.0112, 0.7624, -2.1118, 0.6686, 1.286, 0.5736, -0.3968, -0.6159, -2.5366,
        0.889, 1.2735, 1.264, 1.6454, 0.1415, -0.3455, 1.9907, -1.1351, -1.3031, 0.9842,
        2.6791, -0.6697, -2.1408, 0.656, 0.0338, 1.0945, 0.9726, 3.2911, 0.2005, -2.4944,
    ],
    "asset3": [
        3.0712, 1.2428, -3.184, 3.0923, -0.0131, -2.0597, 2.0496, -0.585, 0.6504, 1.0962,
        2.7193, -0.8361, -4.2316, 1.624, -3.2315, 7.4063, 0.3338, -4.3389, 1.5357, -1.2732,
        -0.208, -0.6808, 1.451, -1.5372, -1.0502, 3.36, -0.3788, -0.1197, -0.1823, -0.1217,
        -4.8028, -0.5589, -0.5277, 3.0093, 1.0955, -2.0927, 0.7881, -1.4555, 2.2117, 2.9634,
        -3.5207, -4.4262, -4.5345, 0.1385, -3.6547, 2.8741, -0.0495, 0.9447, 1.3656, 1.7807,
        -1.7593, 0.9009, -2.0389, 0.1216, 4.0254, 2.3588, 0.7781, -4.9794, 0.2146, -0.2641,
    ],
}

# Means and covariance of three assets, and the riskless rate.
MU3 = [0.06, 0.02, 0.04]
COV3 = [[0.008, -0.002, 0.004], [-0.002, 0.002, -0.002], [0.004, -0.002, 0.008]]
RF3 = 0.01

# Short-rate levels fitted to the base curve; swap states and swaption at notional 1e6, strike
# 3.9 percent, exercise 3.
LEVELS = [
    0.03, 0.0304046076, 0.0306977371, 0.0308900685, 0.0309914918, 0.0310111542, 0.0283663431,
    0.0276687596, 0.0269742348, 0.0262843472,
]
SWAP_STATES = [-33681.546841, -11871.495689, 11573.585741, 36706.372274]
SWAPTION = 8096.5697157
BOND = 57.216858239429
