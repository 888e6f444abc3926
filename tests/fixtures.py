"""Small inputs and expected outputs as CSV text."""

# ---- fixed values: inputs, and the results that must come out of them ----------

SUBMISSIONS = """\
name,domain,task,score,submitted
Aarav,ML,Task2,8,yes
Meera,Web,Task2,6,yes
Kabir,ML,Task2,0,no
Isha,Electronics,Task2,9,yes
Rohan,Web,Task2,4,yes
Tara,ML,Task2,7,yes
Dev,Mechanical,Task2,0,no
"""

STUDENTS = """\
student_id,name,domain,attendance_percent,score,study_hours,height,weight,submitted
S001,Aarav,ml,92%,8,5,170 cm,65 kg,yes
S002,Meera,Web Dev,88,6,3,1.62 m,55kg,Yes
S003,Kabir,ML,,0,0,168cm,,no
S004,Isha,electronics,95%,nine,4,158 cm,50 kg,yes
S005,Rohan,web,72,4,two,172 cm,70kg,yes
S005,Rohan,web,72,4,two,172 cm,70kg,yes
S006,Tara,MACHINE LEARNING,90%,7,6,165cm,58 kg,Y
S007,Dev,Mechanical,-10,0,1,180 cm,80 kg,no
S008,Naina,ML,105%,10,8,160 cm,52 kg,yes
S009,Omkar,Electronics,85%,,2,175 cm,77 kg,N
S010,Diya,web development,80,7,4,1.55 m,49kg,yes
"""

STUDENTS_CLEANED = """\
student_id,name,domain,attendance_percent,score,study_hours,height_cm,weight_kg,submitted
S001,Aarav,ML,92.0,8.0,5.0,170.0,65.0,yes
S002,Meera,Web,88.0,6.0,3.0,162.0,55.0,yes
S003,Kabir,ML,88.0,0.0,0.0,168.0,58.0,no
S004,Isha,Electronics,95.0,9.0,4.0,158.0,50.0,yes
S005,Rohan,Web,72.0,4.0,2.0,172.0,70.0,yes
S006,Tara,ML,90.0,7.0,6.0,165.0,58.0,yes
S007,Dev,Mechanical,88.0,0.0,1.0,180.0,80.0,no
S008,Naina,ML,88.0,10.0,8.0,160.0,52.0,yes
S009,Omkar,Electronics,85.0,7.0,2.0,175.0,77.0,no
S010,Diya,Web,80.0,7.0,4.0,155.0,49.0,yes
"""

MEASUREMENTS = """\
record_id,domain,condition,input_type,input_value,input_unit,replicate,time_step,signal,signal_unit,expected_signal,baseline_signal,voltage_v,current_a,stress_mpa,reference_stress_mpa,temperature_c
B001,Biochem,low_concentration,concentration,0.1,mM,1,1,0.12,absorbance,0.12,0.10,,,,,25
B002,Biochem,low_concentration,concentration,0.1,mM,2,2,0.11,absorbance,0.12,0.10,,,,,25
B003,Biochem,low_concentration,concentration,0.1,mM,3,3,0.13,absorbance,0.12,0.10,,,,,25
B004,Biochem,medium_concentration,concentration,0.5,mM,1,1,0.49,absorbance,0.50,0.10,,,,,25
B005,Biochem,medium_concentration,concentration,0.5,mM,2,2,0.52,absorbance,0.50,0.10,,,,,25
B006,Biochem,medium_concentration,concentration,0.5,mM,3,3,0.51,absorbance,0.50,0.10,,,,,25
B007,Biochem,high_concentration,concentration,1.0,mM,1,1,0.98,absorbance,1.00,0.10,,,,,25
B008,Biochem,high_concentration,concentration,1.0,mM,2,2,1.02,absorbance,1.00,0.10,,,,,25
B009,Biochem,high_concentration,concentration,1.0,mM,3,3,1.01,absorbance,1.00,0.10,,,,,25
E001,Electronics,low_load,load,10,ohm,1,1,4.95,V,5.00,5.00,4.95,0.20,,,35
E002,Electronics,low_load,load,10,ohm,2,2,4.90,V,5.00,5.00,4.90,0.21,,,36
E003,Electronics,low_load,load,10,ohm,3,3,4.92,V,5.00,5.00,4.92,0.20,,,35
E004,Electronics,medium_load,load,20,ohm,1,1,4.70,V,4.70,5.00,4.70,0.24,,,40
E005,Electronics,medium_load,load,20,ohm,2,2,4.65,V,4.70,5.00,4.65,0.25,,,41
E006,Electronics,medium_load,load,20,ohm,3,3,4.68,V,4.70,5.00,4.68,0.24,,,40
E007,Electronics,high_load,load,40,ohm,1,1,4.25,V,4.25,5.00,4.25,0.30,,,48
E008,Electronics,high_load,load,40,ohm,2,2,4.30,V,4.25,5.00,4.30,0.31,,,49
E009,Electronics,high_load,load,40,ohm,3,3,4.10,V,4.25,5.00,4.10,0.35,,,50
M001,Mechanical,low_load,load,50,N,1,1,0.50,mm,0.50,0.50,,,80,100,28
M002,Mechanical,low_load,load,50,N,2,2,0.52,mm,0.50,0.50,,,82,100,28
M003,Mechanical,low_load,load,50,N,3,3,0.51,mm,0.50,0.50,,,81,100,28
M004,Mechanical,medium_load,load,100,N,1,1,1.10,mm,1.10,0.50,,,150,200,28
M005,Mechanical,medium_load,load,100,N,2,2,1.08,mm,1.10,0.50,,,148,200,28
M006,Mechanical,medium_load,load,100,N,3,3,1.11,mm,1.10,0.50,,,152,200,28
M007,Mechanical,high_load,load,150,N,1,1,1.75,mm,1.75,0.50,,,230,300,28
M008,Mechanical,high_load,load,150,N,2,2,1.80,mm,1.75,0.50,,,235,300,28
M009,Mechanical,high_load,load,150,N,3,3,2.10,mm,1.75,0.50,,,270,300,28
"""

REPLICATES = """\
domain,condition,input_type,input_value,input_unit,signal_unit,replicate_count,mean_signal,median_signal,variance_signal,standard_deviation_signal,standard_error_signal,confidence_interval_lower,confidence_interval_upper,coefficient_of_variation,minimum_signal,maximum_signal,stability_flag
Biochem,high_concentration,concentration,1.0,mM,absorbance,3,1.003333,1.01,0.00043333,0.020817,0.012019,0.951622,1.055045,0.020748,0.98,1.02,stable
Biochem,low_concentration,concentration,0.1,mM,absorbance,3,0.12,0.12,0.0001,0.01,0.005774,0.095159,0.144841,0.083333,0.11,0.13,moderate
Biochem,medium_concentration,concentration,0.5,mM,absorbance,3,0.506667,0.51,0.00023333,0.015275,0.008819,0.468721,0.544612,0.030149,0.49,0.52,stable
Electronics,high_load,load,40.0,ohm,V,3,4.216667,4.25,0.01083333,0.104083,0.060093,3.958109,4.475224,0.024684,4.1,4.3,stable
Electronics,low_load,load,10.0,ohm,V,3,4.923333,4.92,0.00063333,0.025166,0.01453,4.860817,4.985849,0.005112,4.9,4.95,stable
Electronics,medium_load,load,20.0,ohm,V,3,4.676667,4.68,0.00063333,0.025166,0.01453,4.614151,4.739183,0.005381,4.65,4.7,stable
Mechanical,high_load,load,150.0,N,mm,3,1.883333,1.8,0.03583333,0.189297,0.109291,1.413094,2.353573,0.100512,1.75,2.1,moderate
Mechanical,low_load,load,50.0,N,mm,3,0.51,0.51,0.0001,0.01,0.005774,0.485159,0.534841,0.019608,0.5,0.52,stable
Mechanical,medium_load,load,100.0,N,mm,3,1.096667,1.1,0.00023333,0.015275,0.008819,1.058721,1.134612,0.013929,1.08,1.11,stable
"""

CALIBRATION = """\
domain,relationship,pearson_r,spearman_r,slope,intercept,r_squared,mae,rmse,n_samples
Biochem,signal vs concentration,0.999319,0.948683,0.981967,0.019617,0.998639,0.011245,0.013347,9
Electronics,signal vs load,-0.98453,-0.948683,-0.023476,5.153333,0.9693,0.037884,0.052109,9
Electronics,signal vs temperature,-0.991995,-0.974824,-0.051953,6.764472,0.984054,0.026689,0.037555,9
Mechanical,signal vs load,0.98407,0.948683,0.013733,-0.21,0.968394,0.077778,0.101288,9
Mechanical,stress_mpa vs load,0.984291,0.948683,1.64,-5.333333,0.96883,9.407407,12.009256,9
"""

READY = """\
record_id,domain,condition,input_value,input_unit,replicate,time_step,signal,signal_unit,rolling_average_signal,normalized_signal,power_w,error_percent,stress_ratio,stability_flag,ml_ready
B007,Biochem,high_concentration,1.0,mM,1,1,0.98,absorbance,0.98,9.8,,-2.0,,stable,True
B008,Biochem,high_concentration,1.0,mM,2,2,1.02,absorbance,1.0,10.2,,2.0,,stable,True
B009,Biochem,high_concentration,1.0,mM,3,3,1.01,absorbance,1.003333,10.1,,1.0,,stable,True
B001,Biochem,low_concentration,0.1,mM,1,1,0.12,absorbance,0.12,1.2,,0.0,,moderate,True
B002,Biochem,low_concentration,0.1,mM,2,2,0.11,absorbance,0.115,1.1,,-8.3333,,moderate,True
B003,Biochem,low_concentration,0.1,mM,3,3,0.13,absorbance,0.12,1.3,,8.3333,,moderate,True
B004,Biochem,medium_concentration,0.5,mM,1,1,0.49,absorbance,0.49,4.9,,-2.0,,stable,True
B005,Biochem,medium_concentration,0.5,mM,2,2,0.52,absorbance,0.505,5.2,,4.0,,stable,True
B006,Biochem,medium_concentration,0.5,mM,3,3,0.51,absorbance,0.506667,5.1,,2.0,,stable,True
E007,Electronics,high_load,40.0,ohm,1,1,4.25,V,4.25,0.85,1.275,0.0,,stable,True
E008,Electronics,high_load,40.0,ohm,2,2,4.3,V,4.275,0.86,1.333,1.1765,,stable,True
E009,Electronics,high_load,40.0,ohm,3,3,4.1,V,4.216667,0.82,1.435,-3.5294,,stable,True
E001,Electronics,low_load,10.0,ohm,1,1,4.95,V,4.95,0.99,0.99,-1.0,,stable,True
E002,Electronics,low_load,10.0,ohm,2,2,4.9,V,4.925,0.98,1.029,-2.0,,stable,True
E003,Electronics,low_load,10.0,ohm,3,3,4.92,V,4.923333,0.984,0.984,-1.6,,stable,True
E004,Electronics,medium_load,20.0,ohm,1,1,4.7,V,4.7,0.94,1.128,0.0,,stable,True
E005,Electronics,medium_load,20.0,ohm,2,2,4.65,V,4.675,0.93,1.1625,-1.0638,,stable,True
E006,Electronics,medium_load,20.0,ohm,3,3,4.68,V,4.676667,0.936,1.1232,-0.4255,,stable,True
M007,Mechanical,high_load,150.0,N,1,1,1.75,mm,1.75,3.5,,0.0,0.766667,moderate,True
M008,Mechanical,high_load,150.0,N,2,2,1.8,mm,1.775,3.6,,2.8571,0.783333,moderate,True
M009,Mechanical,high_load,150.0,N,3,3,2.1,mm,1.883333,4.2,,20.0,0.9,moderate,True
M001,Mechanical,low_load,50.0,N,1,1,0.5,mm,0.5,1.0,,0.0,0.8,stable,True
M002,Mechanical,low_load,50.0,N,2,2,0.52,mm,0.51,1.04,,4.0,0.82,stable,True
M003,Mechanical,low_load,50.0,N,3,3,0.51,mm,0.51,1.02,,2.0,0.81,stable,True
M004,Mechanical,medium_load,100.0,N,1,1,1.1,mm,1.1,2.2,,0.0,0.75,stable,True
M005,Mechanical,medium_load,100.0,N,2,2,1.08,mm,1.09,2.16,,-1.8182,0.74,stable,True
M006,Mechanical,medium_load,100.0,N,3,3,1.11,mm,1.096667,2.22,,0.9091,0.76,stable,True
"""
